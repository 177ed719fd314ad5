"""Sessions, and storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "marlstone", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def guard(spark: SparkSession) -> None:
    """Switch off what gives wrong rows: Spark 4.1 lets a union keep the partitioning of its inputs, and windows above such a
    union, where inputs were themselves partitioned for windows, then miss rows of their partition."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where the setting is absent (tests, one machine) a temporary folder is made
    once and kept in the setting; a cluster without the setting is an error,
    as no machine-local folder can stand in for it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the application's part of the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession) -> None:
    """Remove all that this application wrote in between. Frames that read it can't be used any more."""
    from marlstone.sources.storage import delete

    delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def object_store(endpoint: str, key: str, secret: str, path_style: bool = True) -> dict[str, str]:
    """Settings for a session that reads and writes s3a:// paths of a store at `endpoint`."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.access.key": key, "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(), "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and
    the copy outlives any executor. Columnar, so later reads prune columns."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed(seen: Observation) -> dict:
    """What was observed while a frame was written; nothing, if the plan was found to be empty before it ran."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def spread(df: DataFrame) -> DataFrame:
    """df, a scan, over at least one partition per core, for work that is heavy by row: a small file is one
    split otherwise. Inputs of a cluster's size have more splits than cores and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def sized(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """df with a broadcast hint if a count shows it to be small; else as it is, for a shuffled join. For written frames,
    which a count doesn't compute again."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
