"""Bounded samples of labelled documents, for the two classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], fold: int, folds: int = 3) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class[y]`` labelled documents a class whose fold isn't ``fold``.

    The choice is by a hash of doc_id, so it is the same at every run. The chosen ids are at most the sum of the
    bounds, whatever the tables' sizes, which is why they may be broadcast. A doc_id that is labelled more than once
    has its highest label, and one that several rows bear its smallest text, so the bounds are those of rows as well;
    null labels and ids are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != fold))
    known = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = None
    for y, most in per_class.items():
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
