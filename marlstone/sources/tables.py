"""Parquet tables by name: one folder holds one file or folder per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from marlstone.session import guard


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    guard(spark)
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files and folders of drifting schemas as one frame, by column name."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if path holds readable Parquet; reads footers, never rows."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def register_views(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    """Tables as temporary views of their names, for SQL texts."""
    for name in names:
        table(spark, root, name).createOrReplaceTempView(name)
