"""Coverage and quality profiles of a table, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distribution(df: DataFrame, *keys: str | Column, top: int | None = None) -> DataFrame:
    """Rows by group, most frequent first, ties by key."""
    names = [k if isinstance(k, str) else f"key{i}" for i, k in enumerate(keys)]
    cols = [F.col(k) if isinstance(k, str) else k.alias(n) for k, n in zip(keys, names, strict=True)]
    out = df.groupBy(*cols).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *names)
    return out.limit(top) if top else out


def distributions(df: DataFrame, dims: list[str], group: str) -> DataFrame:
    """(group, dim, value, n) of several columns in one pass: each row is stacked once a column."""
    stacked = df.select(group, F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])).alias("s"))
    return stacked.groupBy(group, "s.dim", "s.value").agg(F.count("*").alias("n"))


def bounds(df: DataFrame, group: str, value: str, label: str | None = None) -> DataFrame:
    """(group, n, low, high) and any one of ``label``, ordered by the group as a number."""
    extra = [F.any_value(label).alias(label)] if label else []
    return df.groupBy(group).agg(*extra, F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).orderBy(F.col(group).try_cast("int"), group)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: rows in all, and how many nulls each column has."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns or df.columns])


def pattern_counts(df: DataFrame, columns: list[str], patterns: dict[str, str]) -> DataFrame:
    """(pattern, n): rows in which any of the columns matches; a row counts for every pattern that it matches."""
    sums = [F.count_if(_any(F.col(c).rlike(p) for c in columns)).alias(f"c{i}") for i, p in enumerate(patterns.values())]
    totals = df.agg(*sums)
    return totals.select(F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.col(f"c{i}").alias("n")) for i, n in enumerate(patterns)])).alias("r")).select("r.*")


def _any(columns) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(c, F.lit(False))
    return out


def text_presence(df: DataFrame, text: str, bound: int = 50) -> DataFrame:
    """(with_text, without_text, untitled-style very_short): a text of exactly ``bound`` characters is in neither of the first two."""
    n = F.length(text)
    return df.agg(
        F.count_if(n > bound).alias("with_text"),
        F.count_if(F.col(text).isNull() | (n < bound)).alias("without_text"),
        F.count_if(F.col(text).isNull() | (n < 5)).alias("very_short"),
    )


def key_profile(df: DataFrame, map_col: str) -> DataFrame:
    """(key, n, min_size, avg_size, max_size) of a map column's keys."""
    e = df.select(F.explode(map_col).alias("key", "value"))
    size = F.length("value")
    return e.groupBy("key").agg(F.count("*").alias("n"), F.min(size).alias("min_size"), F.avg(size).alias("avg_size"), F.max(size).alias("max_size"))


def seeded_sample(df: DataFrame, key: str, k: int, seed: str = "") -> DataFrame:
    """``k`` rows chosen by a hash of the key: random to look at, the same at every run."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(k)


def members(df: DataFrame, group: str, member: str) -> DataFrame:
    """(group, n, members): distinct members by group, sorted; for groups that are known to be short."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(member)).alias("members"))


def forecast(sample: DataFrame, totals: DataFrame, group: str, size: str) -> DataFrame:
    """(group, sampled, mean_size, total, expected): what all ``total`` rows of a group will come to at the sample's mean.

    totals: (group, total). A group without a sample is expected at the mean of the whole sample.
    """
    means = sample.groupBy(group).agg(F.count("*").alias("sampled"), F.avg(size).alias("mean_size"))
    overall = F.broadcast(sample.agg(F.avg(size).alias("_overall")))  # one row
    joined = totals.join(means, group, "left").join(overall)
    mean = F.coalesce("mean_size", "_overall")
    return joined.select(group, F.coalesce("sampled", F.lit(0)).cast("long").alias("sampled"), mean.alias("mean_size"), "total", (mean * F.col("total")).alias("expected"))
