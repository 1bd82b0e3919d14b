"""Sinks: whole tables, partitions of children, JSON reports and databases."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_temporary: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: the one that ``spark.checkpoint.dir`` names.

    Where the setting is absent a temporary folder is made for the session, on a single machine (tests) only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _temporary:
        _temporary[app] = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(_temporary[app])
    return _temporary[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; it is deleted when the driver's Python ends."""
    path = f"{shared_folder(spark)}/tessera-{label}-{uuid.uuid4().hex[:12]}"
    atexit.register(delete_path, spark, path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read again, so that what follows doesn't compute it anew."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have been stopped before
        pass


def reload_table(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Only the partitions that df has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def bulk_load(df: DataFrame, url: str, name: str, batch: int = 1000, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=name, batchsize=str(batch), **options).mode("append").save()
