"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.writers import delete_path
from ..sources.writers import scratch_path as new_path

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete saved tables that nothing will read any more."""
    for table in tables:
        if table is not None:
            delete_path(table.sparkSession, table.saved_at)


def join_spread(many: DataFrame, few: DataFrame, key: str, by: str, parts: int = 64, small: int = 50_000) -> DataFrame:
    """many.join(few, key) where one key may hold most rows of ``many``.

    Up to ``small`` rows of ``few`` are broadcast. Beyond it the rows of a key are dealt over ``parts`` tasks by a hash
    of the column ``by``, and the rows of ``few``, which is meant to be much smaller, go to each of them.
    """
    if few.count() <= small:
        return many.join(F.broadcast(few), key)
    left = many.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    right = few.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.join(right.hint("merge"), [key, "_part"]).drop("_part")


#: Rows of a saved table that join_small broadcasts: some 10 MB.
MOST_BROADCAST_ROWS = 200_000


def join_small(many: DataFrame, few: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """many.join(few, on), without a shuffle where ``few``, read from a saved table, has up to MOST_BROADCAST_ROWS rows."""
    return many.join(F.broadcast(few) if few.count() <= MOST_BROADCAST_ROWS else few, on, how)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python tasks in batches of about BATCH_BYTES from now on, where the session has no setting of its own.

    Spark's default, 64 MB or 10,000 rows, is held several times over by each task, in the JVM's direct memory and in Python,
    and both keep what they once took. Results don't depend on it.
    """
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def fold_of(doc_id, buckets: int):
    """crc32 of the id written as text, modulo ``buckets``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def with_field(df: DataFrame, name: str, kind: str) -> T.StructType:
    """The schema of df with one more column; df's own schema object stays as it is."""
    return T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
