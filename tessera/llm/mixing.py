"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, release, saved

_TOLERANCE, _MOST_STEPS = 1e-7, 200
_STATE_FILES = 4  # a row a source is little; many files of it would cost each step more than its sums


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the words of each text, 0 for a null one."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code-point order (null last) take the weights in turn. Targets share ``share`` times all sizes by
    weight; none exceeds ``cap`` times its source's size, and what is cut off is shared among the others by weight.
    That is a water level: target = least(cap * size, weight * level). The windows run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("full_at", F.col("most") / F.col("weight"))
    order = Window.orderBy("full_at", "place")
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        ranked.withColumn("budget", F.sum("source_size").over(all_rows) * F.lit(float(share)))
        .withColumn("filled", F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("left"))
    )
    level = F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "place", "level"))).over(all_rows)["level"]
    return ranked.withColumn("at", level).select("source", "source_size", F.least("most", F.coalesce(F.col("weight") * F.col("at"), F.col("most"))).alias("target"))


def balanced_tilts(histogram: DataFrame, wanted: DataFrame, cap: float) -> DataFrame:
    """(s, unit, tilt) by source: documents of size z are to be taken at the rate least(cap, exp(tilt * z / unit)).

    These rates have the least relative entropy against taking every document once, among all whose words come to
    ``wanted`` (s, unit, target, tilt) and that nowhere exceed ``cap``: the dual of that problem is convex with one
    multiplier, the tilt, for each source's token constraint, and the bound clips the rates. Newton steps on the
    logarithm of the words, kept inside a bracket of the root, take words and slope from one distributed sum over the
    histogram of sizes. Sums are of whole numbers, so they don't depend on the order of rows. A source that is to be
    taken ``cap`` times whole has a null tilt: the root is at infinity.
    """
    endless = F.lit(float("inf"))
    state = saved(wanted.select("s", "unit", "target", "tilt", (-endless).alias("low"), endless.alias("high"), F.lit(False).alias("done")).coalesce(_STATE_FILES), "mix-tilts")
    z = F.col("size") / F.col("unit")
    rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * z, F.lit(40.0))))
    for _ in range(_MOST_STEPS):
        open_ = state.where(~F.col("done"))
        sums = (
            histogram.join(open_.select("s", "unit", "tilt"), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("s")
            .agg(_exact_sum(F.col("n") * F.col("size") * rate).alias("words"), _exact_sum(F.when(rate < cap, F.col("n") * F.col("size") * rate * z).otherwise(0.0)).alias("slope"))
        )
        gap = F.when(F.col("words") <= 0, -1.0).otherwise(F.log(F.col("words") / F.col("target")))
        newton = F.col("tilt") - gap * F.try_divide("words", "slope")  # null where all rates are at the bound
        reach = F.greatest(F.lit(2.0), F.abs("tilt"))
        stepped = F.greatest(F.col("tilt") - reach, F.least(F.col("tilt") + reach, F.coalesce(newton, F.when(gap < 0, F.col("tilt") + reach).otherwise(F.col("tilt") - reach))))
        middle = (F.col("low") + F.col("high")) / 2
        inside = (stepped > F.col("low")) & (stepped < F.col("high"))
        at_end = F.coalesce(F.abs(gap) < _TOLERANCE, F.lit(True)) | (F.col("high") - F.col("low") < 1e-12 * F.greatest(F.lit(1.0), F.abs("tilt")))
        old, state = (
            state,
            saved(
                state.join(sums.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t")), "left")
                .withColumn("high", F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")))
                .withColumn("low", F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low")))
                .withColumn("next", F.when(inside, stepped).otherwise(middle))
                .select("s", "unit", "target", F.when(F.col("done") | at_end, F.col("tilt")).otherwise(F.col("next")).alias("tilt"), "low", "high", (F.col("done") | at_end).alias("done"))
                .coalesce(_STATE_FILES),
                "mix-tilts",
            ),
        )
        release(old)
        if state.where(~F.col("done")).isEmpty():
            return state.select("s", "unit", "tilt")
    raise ArithmeticError("the tilts of some sources did not converge")


def _exact_sum(x):
    """A sum that is the same in any order: of whole millionths."""
    return (F.sum(F.round(x * 1e6).cast("decimal(38,0)")).cast("double") / 1e6)


def _wanted(sized: DataFrame, targets: DataFrame, cap: float, tilt) -> DataFrame:
    """(s, unit, target, tilt) of the sources in ``sized`` (s, words, docs), without those that are taken ``cap`` times or not at all."""
    joined = sized.join(targets.select(F.col("source").alias("t"), "target"), F.col("s").eqNullSafe(F.col("t")))
    joined = joined.where((F.col("target") > 0) & (F.col("target") < F.col("words") * cap * (1 - 1e-12)))
    return joined.select("s", (F.col("words") / F.col("docs")).alias("unit"), "target", tilt.alias("tilt"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    fine_share: float = 0.2,
    rows_per_bucket: int = 512,
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    Returns doc_id, size (words of the text, 0 for null), source_size, target, rate, copies, taken = copies * size and source.
    Rates are exponential tilts by size (see ``balanced_tilts``). Documents of a source are taken from the longest to
    the shortest, and copies are the whole steps of the running sum of rates, so counts never drift from the rates.
    Rounding leaves some words of the target over or short, up to those of one long text; the documents that hold the
    last ``fine_share`` of a source's words are therefore balanced once more, against what is left of the target; a
    source misses its target by about half of one of those short texts. No document has more than ceil(cap) copies.

    Every row counts, repeated rows each for themselves. Null sources form one source, the last; a null doc_id is
    kept; empty texts have size 0 and take nothing; an empty table gives no rows. Other columns are ignored. Only
    columns that sizes need are read, and texts are read once. Ties in size are ordered by a hash of doc_id, and
    equal sizes are ranked in buckets of ``rows_per_bucket`` rows, so that a source or size with most of the rows
    does not meet in one task.
    """
    sized = saved(document_sizes(docs), "mix-sizes")
    histogram = saved(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    targets = saved(source_targets(sized, weights, share, cap), "mix-targets")
    filled = histogram.where("size > 0")
    whole = filled.groupBy(F.col("source").alias("s")).agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"))
    tilts = balanced_tilts(filled, _wanted(whole, targets, cap, F.log(F.col("target") / F.col("words"))), cap)

    # the histogram has a row for each size of a source, never more than the longest text has words
    down = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ladder = filled.join(targets.select(F.col("source").alias("t"), "source_size", "target"), F.col("source").eqNullSafe(F.col("t"))).drop("t")
    ladder = _with_rates(ladder, tilts, cap).withColumn("fine", F.coalesce(F.sum(F.col("n") * F.col("size")).over(down), F.lit(0)) >= F.col("source_size") * F.lit(1 - fine_share))
    ladder = saved(ladder.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(down), F.lit(0.0))), "mix-ladder")

    # what the rounding of the longer documents leaves to the fine ones
    coarse = ladder.where("not fine").groupBy(F.col("source").alias("c")).agg(F.sum(F.col("size") * _steps(F.col("before"), F.col("n") * F.col("rate"))).alias("coarse"))
    left = targets.join(coarse, F.col("source").eqNullSafe(F.col("c")), "left").select("source", F.greatest(F.lit(0.0), F.col("target") - F.coalesce("coarse", F.lit(0))).alias("target"))
    fine = ladder.where("fine")
    sums = fine.groupBy(F.col("source").alias("s")).agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"))
    again = balanced_tilts(fine.select("source", "size", "n"), _wanted(sums, saved(left, "mix-left"), cap, F.lit(0.0)), cap)
    fine = _with_rates(fine.drop("rate", "before").join(left.select(F.col("source").alias("l"), F.col("target").alias("rest")), F.col("source").eqNullSafe(F.col("l"))), again, cap, F.col("rest"))
    fine = fine.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(down), F.lit(0.0)))
    columns = [F.col("source").alias("s"), F.col("size").alias("z"), "n", "before", "rate"]
    ladder = saved(ladder.where("not fine").select(*columns).unionByName(fine.select(*columns)), "mix-rates")

    per_source = targets.select(F.col("source").alias("t"), "source_size", "target")
    placed = sized.join(ladder, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / rows_per_bucket)))
    buckets = placed.groupBy("source", "size", "bucket").agg(F.count("*").alias("in_bucket"))
    ahead = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("bucket").alias("k"), F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source", "size", "bucket").orderBy(F.xxhash64("doc_id", F.lit("mix")), "doc_id")
    copies = _steps(F.col("before") + (F.col("ahead") + F.col("place")) * F.col("rate"), F.col("rate"))
    placed = (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(buckets, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bucket") == F.col("k")))
        .select("doc_id", "size", "source", "rate", copies.cast("long").alias("copies"))
    )
    empty = sized.where("size = 0").select("doc_id", "size", "source", F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("copies"))
    return (
        placed.unionByName(empty)
        .join(per_source, F.col("source").eqNullSafe(F.col("t")))
        .select("doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), "source")
    )


def _with_rates(ladder: DataFrame, tilts: DataFrame, cap: float, target=None) -> DataFrame:
    """ladder with the rate of each size; a source without a tilt is taken ``cap`` times, or not at all where it has no target."""
    joined = ladder.join(tilts, F.col("source").eqNullSafe(F.col("s")), "left")
    tilted = F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("unit"), F.lit(40.0))))
    plain = F.when((F.col("target") if target is None else target) > 0, F.lit(float(cap))).otherwise(0.0)
    return joined.withColumn("rate", F.round(F.coalesce(tilted, plain), 9)).drop("s", "unit", "tilt")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as ``mix_sources`` with these options takes it.

    A doc_id must name one row. Rows without one are told apart by source, size and the order of their texts, so each
    of them has copies of its own too; few rows are meant to have none. Texts without words are never taken.
    """
    taken = saved(mix_sources(docs, **options).where("copies > 0").select("doc_id", "source", "size", "copies"), "mix-taken")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").alias("i"))
    named = rows.join(taken.select(F.col("doc_id").alias("i"), "copies").where("i is not null"), "i").select("row", "copies")
    alike = Window.partitionBy("s", "z")
    alone = rows.where("i is null").withColumn("s", F.col("row.source")).withColumn("z", F.regexp_count("row.text", F.lit(WORD)).cast("long"))
    alone = alone.where("z > 0").withColumn("place", F.row_number().over(alike.orderBy("row.text")))
    own = taken.where("doc_id is null").select(F.col("source").alias("s"), F.col("size").alias("z"), "copies")
    own = own.withColumn("place", F.row_number().over(alike.orderBy(F.desc("copies")))).withColumnRenamed("s", "of")
    nameless = alone.join(own, ["z", "place"]).where(F.col("s").eqNullSafe(F.col("of"))).select("row", "copies")
    return named.unionByName(nameless).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def _steps(start, more):
    """Whole numbers that a running sum of rates passes from ``start`` on, by ``more``."""
    return F.floor(start + more + F.lit(0.49)) - F.floor(start + F.lit(0.49))
