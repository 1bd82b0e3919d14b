"""Write semantics on DataFrames: each takes what a table holds and what comes, and returns what it then holds.

Plain Parquet has no MERGE, so an upsert is a union and a window, or a join; Spark drops all but the first row of each
key before it sorts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def last_wins(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows by key: a new row replaces an old one; among new rows the last by ``order`` counts, which must tell them apart."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, key, F.desc("_new"), F.desc(order)).drop("_new")


def first_wins(old: DataFrame, new: DataFrame, key: list[str], order: str | None = None, compat: bool = False) -> DataFrame:
    """Rows by key: what is there stays; of new rows the first by ``order``. With ``compat`` keys with a null never clash."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    ranked = both.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy("_new", *([order] if order else []))))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return ranked.where((F.col("_n") == 1) | (has_null if compat else F.lit(False))).drop("_n", "_new")


def keep_old_if_null(old: DataFrame, new: DataFrame, key: list[str], always: tuple[str, ...] = ()) -> DataFrame:
    """Rows by key: a new value counts where it isn't null, else the old one; columns in ``always`` are overwritten."""
    values = [c for c in old.columns if c not in key]
    n = new.select(*key, *[F.col(c).alias("_" + c) for c in values], F.lit(True).alias("_there"))
    joined = old.join(n, key, "full")
    pick = [F.when(F.col("_there"), F.col("_" + c)).otherwise(F.col(c)).alias(c) if c in always else F.coalesce("_" + c, c).alias(c) for c in values]
    return joined.select(*key, *pick)


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """All children of the parents in ``new`` are replaced by the new ones."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def update_by_key(table: DataFrame, changes: DataFrame, key: str, column: str, order: str, fold_case: bool = False) -> DataFrame:
    """``column`` set where a change has the row's key, to the last change by ``order`` (ties: the greatest value); with
    ``fold_case`` keys are compared in upper case."""
    left = F.upper(F.col(key)) if fold_case else F.col(key)
    c = changes.groupBy((F.upper(F.col(key)) if fold_case else F.col(key)).alias("_key")).agg(F.max_by(column, F.struct(order, column)).alias("_value"))
    return table.join(c, left == F.col("_key"), "left").withColumn(column, F.coalesce("_value", column)).drop("_key", "_value")


def remap_keys(children: DataFrame, mapping: DataFrame, old_key: str, new_key: str) -> DataFrame:
    """Children under new parent keys; those whose parent has none are dropped. mapping: (old_key, new_key)."""
    return children.join(mapping, old_key).drop(old_key)


def capped(df: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Texts cut to their columns' lengths, as sinks ask for."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in caps.items()})
