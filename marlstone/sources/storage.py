"""Files and folders of the file system a path names, what a storage tree holds, and small sinks.

Every path goes through the session's Hadoop file systems, so reports land on the storage all
executors share. A folder is published by two renames; they are atomic on HDFS-like file systems. On an
object store a rename copies: use one of its committers there, or publish into a fresh path.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_system(spark: SparkSession, path: str):
    """The file system of path, and the class that makes its paths."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, P = file_system(spark, path)
    return bool(fs.exists(P(path)))


def upload(spark: SparkSession, local: str, path: str) -> None:
    fs, P = file_system(spark, path)
    fs.copyFromLocalFile(False, True, P(local), P(path))


def download(spark: SparkSession, path: str, local: str) -> None:
    fs, P = file_system(spark, path)
    fs.copyToLocalFile(False, P(path), P(local), True)


def delete(spark: SparkSession, path: str) -> None:
    fs, P = file_system(spark, path)
    if fs.exists(P(path)) and not fs.delete(P(path), True):
        raise OSError(f"could not delete {path}")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    fs, P = file_system(spark, path)
    out = fs.create(P(path), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    write_text(spark, json.dumps(report, default=str, indent=1), path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# publishing -----------------------------------------------------------------------------------------


def _superseded(path: str) -> str:
    return f"{path.rstrip('/')}.superseded"


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Bring a publication that was cut short to an end: with no table at path the superseded one
    comes back, else it is removed. For the one writer of a table, before it reads or publishes."""
    fs, P = file_system(spark, path)
    old, live = P(_superseded(path)), P(path)
    if fs.exists(old):
        if fs.exists(live):
            delete(spark, _superseded(path))
        else:
            _rename(fs, old, live)


def rename_into_place(spark: SparkSession, staged: str, path: str) -> None:
    """Swap a finished folder in. Stopped at any point, `recover` leaves the old table or the new one, whole."""
    recover(spark, path)
    fs, P = file_system(spark, path)
    old, live = P(_superseded(path)), P(path)
    had = fs.exists(live)
    if had:
        _rename(fs, live, old)
    elif live.getParent() is not None:
        fs.mkdirs(live.getParent())
    try:
        _rename(fs, P(staged), live)
    except Exception:
        if had and not fs.exists(live):
            _rename(fs, old, live)
        raise
    if had:
        delete(spark, _superseded(path))


# what is there --------------------------------------------------------------------------------------


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes, modified of every file under root; contents aren't read (the column is pruned)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """layer, dataset, files, bytes by the first two folders under root."""
    rest = F.regexp_replace("path", "^.*?" + root.strip("/").split("/")[-1] + "/", "")
    parts = listing(spark, root).select(F.split_part(rest, F.lit("/"), F.lit(1)).alias("layer"), F.split_part(rest, F.lit("/"), F.lit(2)).alias("dataset"), "bytes")
    return parts.groupBy("layer", "dataset").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
