"""Joins that match by substring, prefix or pattern against small dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_name


def first_key_in(name: Column, registry: list[tuple[str, str]], compat: bool = True) -> Column:
    """The value of the first key that the normalised name contains; null without any.

    ``compat`` takes keys as they stand, in order. Otherwise keys are normalised like names and the longest wins, so
    a protocol isn't taken for the convention that it names.
    """
    nn = normalize_name(name)
    keys = registry if compat else sorted(((" ".join(k.replace(",", " ").split()), v) for k, v in registry), key=lambda kv: -len(kv[0]))
    out = None
    for k, v in keys:
        out = F.when(nn.contains(k), v) if out is None else out.when(nn.contains(k), v)
    return out


#: Characters of the stretches by which a large dictionary meets texts.
GRAM = 4


def dictionary_join(df: DataFrame, text: Column, dictionary: DataFrame, key: str, ordinal: str, most_rows: int = 10_000) -> DataFrame:
    """df with the dictionary row of the smallest ordinal (null counts as 0; ties by key) whose key the text contains.

    Up to ``most_rows`` rows of the dictionary go to every task. A larger one is met by equality: each key by the
    stretch of up to GRAM characters of it that fewest keys have, each text by all of its stretches; what meets is
    then verified, so both ways give the same rows. Each distinct text is matched once. A null text, and one that
    contains no key, has nulls; an empty key is contained in every text; null keys match nothing.
    """
    keys = dictionary.where(F.col(key).isNotNull())
    row = F.struct(*[F.col(c) for c in dictionary.columns])
    keys = keys.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(F.coalesce(F.col(ordinal), F.lit(0)).alias("o"), F.col(key).alias("k"))).alias("_order"), F.min_by(row, F.coalesce(F.col(ordinal), F.lit(0))).alias("_row"))
    texts = df.select(text.alias("_text")).where("_text is not null").distinct()
    if keys.limit(most_rows + 1).count() <= most_rows:
        hits = texts.join(F.broadcast(keys), F.contains("_text", F.col("_key")))
    else:
        hits = _met_by_grams(texts, keys).where(F.contains("_text", F.col("_key")))
    best = hits.groupBy("_text").agg(F.min_by("_row", "_order").alias("_row"))
    return df.withColumn("_match", text).join(best, F.col("_match") == F.col("_text"), "left").select(*df.columns, "_row.*")


def _grams(c: Column, size: Column) -> Column:
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(chars) - size + 1), lambda i: F.array_join(F.slice(chars, i, size), "")))


def _met_by_grams(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(_text, _key, _order, _row) of texts and keys that share the key's rarest stretch."""
    size = F.least(F.length("_key"), F.lit(GRAM))
    grams = keys.where("_key <> ''").select("_key", F.explode(_grams(F.col("_key"), size)).alias("gram"))
    often = grams.groupBy("gram").agg(F.count("*").alias("n"))
    anchors = grams.join(often, "gram").groupBy("_key").agg(F.min(F.struct("n", "gram")).alias("a")).select("_key", F.col("a.gram").alias("gram"))
    anchored = keys.join(anchors, "_key")
    sizes = F.array(*[F.lit(n) for n in range(1, GRAM + 1)])
    stretches = texts.withColumn("size", F.explode(F.filter(sizes, lambda n: n <= F.length("_text")))).select("_text", F.explode(_grams(F.col("_text"), F.col("size"))).alias("gram"))
    wanted = stretches.join(anchors.select("gram").distinct(), "gram", "left_semi")
    met = wanted.join(anchored, "gram").select("_text", "_key", "_order", "_row")
    empty = keys.where("_key = ''")  # a row at most
    return met.unionByName(texts.join(F.broadcast(empty)).select("_text", "_key", "_order", "_row"))


def prefix_overlap(left: DataFrame, right: DataFrame, column: str, n: int = 60) -> DataFrame:
    """left with ``hits``: rows of right whose text begins with the first ``n`` characters of the left text.

    Heads are joined by equality where both texts have ``n`` characters, so no pair is compared needlessly; shorter
    left texts are joined at their own length, one equality join a length that occurs.
    """
    heads = left.select(F.substring(column, 1, n).alias("head")).where("head is not null and head <> ''").distinct().withColumn("size", F.length("head"))
    cuts = right.select(F.col(column).alias("t")).where("t is not null")
    sizes = heads.select("size").distinct()
    spread = cuts.join(F.broadcast(sizes), F.length("t") >= F.col("size")).select(F.expr("substring(t, 1, size)").alias("head"), "size")  # at most n sizes
    counts = spread.groupBy("head", "size").agg(F.count("*").alias("hits")).join(heads, ["head", "size"]).select("head", "hits")
    return left.withColumn("_head", F.substring(column, 1, n)).join(counts, F.col("_head") == F.col("head"), "left").drop("_head", "head").withColumn("hits", F.coalesce("hits", F.lit(0)))


def presence_matrix(df: DataFrame, group: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """One row per group with a 0/1 column for each pattern, whether any text matches, and ``gaps``, how many don't."""
    found = [F.max(F.when(F.col(text).rlike(p), 1).otherwise(0)).alias(n) for n, p in patterns.items()]
    return df.groupBy(group).agg(*found).withColumn("gaps", F.lit(len(patterns)) - sum((F.col(n) for n in patterns), F.lit(0)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], optional: list[str], how: str = "inner") -> DataFrame:
    """left joined with right by keys, of which the ``optional`` ones count as empty where they are null. Right's copies of
    the keys go, so a null stays what it was on the left."""
    def named(k: str, c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) if k in optional else F.col(c)

    r = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [named(k, k) == named(k, f"_{k}") for k in keys]
    return left.join(r, on, how).drop(*[f"_{k}" for k in keys])


def find_or_widen(df: DataFrame, column: str, wanted: list[str], wider: list[str], most: int = 5) -> DataFrame:
    """Rows whose lower-cased column is like any of ``wanted``; where there is none, the first ``most`` like any of ``wider``.

    Both are found in one pass: the best level that occurs is one row, which is joined back.
    """
    name = F.lower(F.col(column))
    level = F.when(_like_any(name, wanted), 1).when(_like_any(name, wider), 2)
    found = df.withColumn("_level", level).where("_level is not null")
    best = found.agg(F.min("_level").alias("_level"))
    chosen = found.join(F.broadcast(best), "_level")  # one row
    few = chosen.where("_level = 2").orderBy(column).limit(most)
    return chosen.where("_level = 1").unionByName(few).drop("_level")


def like_counts(df: DataFrame, group: str, column: str, patterns: list[str], top: int | None = None) -> DataFrame:
    """(group, n) of rows whose lower-cased column is like any of the patterns, most first."""
    out = df.where(_like_any(F.lower(F.col(column)), patterns)).groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group)
    return out.limit(top) if top else out


def _like_any(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.like(p)
    return out
