"""A training-data pipeline: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import minhash, mixing, quality, sentencepiece_codec, toxicity
from tessera.llm.common import new_path, read_table, saved, small_batches

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark, docs, sf_dir):
    """Documents that the quality classifier scores at 0.5 or more.

    Null and empty texts are scored by their end mark alone; ids aren't looked at, so rows without one and repeated rows
    go or stay by their texts; without labels all score 0.5 and stay; an empty table stays empty.
    """
    small_batches(spark)
    scored = quality.with_quality(docs, read_table(spark, sf_dir, "labels"))
    return scored.where("score >= 0.5").select(*_COLUMNS)


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity scorer puts below 0.7.

    Null and empty texts have no hits and stay; ids aren't looked at; without labels all stay; an empty table stays empty.
    """
    small_batches(spark)
    scored = toxicity.with_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.where("score < 0.7").select(*_COLUMNS)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies, the one with the smallest doc_id, in one row.

    Rows without a doc_id, and those whose doc_id several rows bear, are documents by their id and text: they go by a
    hash of both, so rows that repeat an id with other texts are compared as any others, and equal rows are one. Of
    rows that differ only in other columns the smallest stays. Texts without words are near nothing; an empty table
    stays empty.
    """
    keyed = docs.select(*_COLUMNS)
    several = saved(keyed.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "several")
    own = F.col("doc_id").isNull() | F.col("repeated").isNotNull()
    keyed = keyed.join(_small(several.withColumn("repeated", F.lit(1))), "doc_id", "left")
    # hashes are above ids, and highest without one, so that of a group a row with an id of its own stays, or with one
    above = F.when(F.col("doc_id").isNull(), F.lit(3 << 61)).otherwise(F.lit(1 << 62))
    hashed = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 61) - 1)) + above
    keyed = keyed.withColumn("key", F.when(own, hashed).otherwise(F.col("doc_id"))).withColumn("own", own)
    judged = minhash.near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"))
    # few keys have to be named: those of the documents that go
    gone = saved(judged.where("not kept").select(F.col("doc_id").alias("key")).distinct(), "gone")
    stay = keyed.join(_small(gone), "key", "left_anti")
    lone = stay.where("not own").select(*_COLUMNS)
    one_each = stay.where("own").groupBy("key").agg(F.min(F.struct(*_COLUMNS)).alias("row")).select("row.*")
    return lone.unionByName(one_each)


def _small(ids):
    """To be broadcast where its size allows, else joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= minhash.MOST_BROADCAST_IDS else ids


def mix(spark, docs, sf_dir):
    """Every document as often as the mix takes it, at most twice.

    Null sources are one source; documents without words are never taken; rows without a doc_id are mixed as well; ties
    in size go by a hash of doc_id; an empty table stays empty.
    """
    return mixing.mixed_documents(docs.select(*_COLUMNS))


def encode(spark, docs, sf_dir):
    """doc_id, lang, source, n_tokens and ids of every document of the mix, repeated ones each; null and empty texts have no ids."""
    small_batches(spark)
    encoded = sentencepiece_codec.encode_texts(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding", encode),
]

#: Learned scores and tokenizers aren't SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over documents, each written as Parquet to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
