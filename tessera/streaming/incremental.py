"""Incremental work: what is still to do, micro-batches over files, and streams of events."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import last_wins


def pending(wanted: DataFrame, *done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in none of the ``done`` tables."""
    seen = reduce(lambda a, b: a.unionByName(b), [d.select(key) for d in done]).distinct()
    return wanted.join(seen, key, "left_anti")


def incomplete_pages(plan: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Planned pages without a ledger entry of the same size that brought anything."""
    good = ledger.where("count > 0").select(*keys, "size")
    return plan.join(good, [*keys, "size"], "left_anti")


def with_missing(missing: DataFrame, found_out: DataFrame, key: str, order: str) -> DataFrame:
    """The table of what was asked for and isn't there (key, reason, order), with what was found out since; the last
    reason counts. ``pending`` takes it as one of its tables, so nothing is asked for again in vain."""
    return last_wins(missing, found_out, [key], order)


def run_lengths(df: DataFrame, partition: str | None, order: str, hit: str, block: int = 100_000) -> DataFrame:
    """df with ``misses``: how many rows in a row up to this one are no hits (a hit has 0).

    Without a partition ``order`` must be a number: runs are counted in blocks of so many places, and a block begins
    with what the blocks before it leave, so that no task sees all rows.
    """
    spans = df if partition else df.withColumn("_block", F.floor(F.col(order) / block))
    base = partition or "_block"
    island = spans.withColumn("_hits", F.sum(F.col(hit).cast("int")).over(Window.partitionBy(base).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    count = F.sum((~F.col(hit)).cast("int")).over(Window.partitionBy(base, "_hits").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    counted = island.withColumn("misses", count)
    if partition:
        return counted.drop("_hits")
    # one row a block: has it a hit, and the misses at its end
    blocks = counted.groupBy("_block").agg((F.max("_hits") > 0).alias("any"), F.max_by("misses", order).alias("tail"))
    so_far = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("run", F.sum(F.col("any").cast("int")).over(so_far))
    left = blocks.withColumn("left", F.sum("tail").over(Window.partitionBy("run").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)))
    carried = left.select("_block", F.coalesce(F.lag("left").over(Window.orderBy("_block")), F.lit(0)).alias("_carried"))
    joined = counted.join(carried, "_block")
    return joined.withColumn("misses", F.when(F.col("_hits") == 0, F.col("misses") + F.col("_carried")).otherwise(F.col("misses"))).drop("_hits", "_block", "_carried")


def stop_place(df: DataFrame, order: str, hit: str, most_misses: int, after: int) -> DataFrame:
    """(stop_at): where a probe would give up, after ``most_misses`` misses in a row beyond place ``after``."""
    return run_lengths(df, None, order, hit).where((F.col("misses") >= most_misses) & (F.col(order) > after)).agg(F.min(order).alias("stop_at"))


def carry_forward(df: DataFrame, partition: str, order: str, column: str, into: str) -> DataFrame:
    """df with the last non-null value of ``column`` so far."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(into, F.last(column, ignorenulls=True).over(w))


def process_new_files(spark: SparkSession, folder: str, schema, batch: Callable[[DataFrame, int], None], checkpoint: str, files_a_batch: int = 100) -> StreamingQuery:
    """Hands files that weren't seen before to ``batch``, some at a time, until none is left.

    The checkpoint is the ledger: a file is done once its batch is, and a batch that fails comes again. ``batch`` must
    be idempotent, as upserts and child replacement are.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_writer(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A batch function for ``process_new_files`` that can run again: each batch has a folder of its own, which a second
    run replaces."""

    def write(df: DataFrame, number: int) -> None:
        shape(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def windowed_counts(events: DataFrame, time: str, keys: list[str], size: str = "10 minutes", late: str | None = "30 minutes", slide: str | None = None) -> DataFrame:
    """Counts by time window and keys; events later than ``late`` behind the newest are dropped (None: the stream has its watermark)."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return (events.withWatermark(time, late) if late else events).groupBy(w, *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, time: str, user: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), user).agg(F.count("*").alias("n"))


def distinct_events(events: DataFrame, time: str, key: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark, with state that is given up as time goes on."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
