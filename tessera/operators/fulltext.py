"""Spanish full-text search with stems, phrases and ranks by cover density, over postings with positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .retrieval import terms

#: Endings by pass, over words without marks; of each pass the longest that leaves LEAST_STEM letters goes.
ENDINGS = (
    (
        "amientos amiento imientos imiento aciones acion uciones ucion adoras adores adora ador ancias ancia encias encia logias logia idades idad"
        " ivamente amente mente ivas ivos iva ivo osas osos osa oso ables able ibles ible istas ista ismos ismo"
        " ariamos eriamos iriamos aremos eremos iremos abamos asemos iesen ieron iendo ando aban abas aba aron aran aras ara eran eras era iran iras"
        " arian erian irian aria eria iria ados adas ado ada idos idas ido ida amos emos imos ases ase iese ar er ir an en"
    ).split(),
    "os as es a o e s".split(),
)
LEAST_STEM = 3
#: Covers of up to so many words count whole.
NEAR = 16
#: So many stems are sent to all tasks.
FEW_TERMS = 100_000


def ending_patterns() -> list[str]:
    """The passes as patterns: a stem, as short as may be, before one of the endings."""
    return [f"^(.{{{LEAST_STEM},}}?)(?:{'|'.join(own)})$" for own in ENDINGS]


def stem(word: Column | str) -> Column:
    """The stem of a folded word: one ending of each pass is cut off."""
    out = F.col(word) if isinstance(word, str) else word
    for pattern in ending_patterns():
        out = F.regexp_replace(out, pattern, "$1")
    return out


def positional_postings(df: DataFrame, id_col: str, *columns: str, wanted: DataFrame | None = None) -> DataFrame:
    """(id, term, positions): where in each text each stem stands, from 0; columns count as one text. Null ids are left out.

    ``wanted`` (term) leaves only these stems, before anything is shuffled where they are at most ``FEW_TERMS``.
    """
    words = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.posexplode(terms(*columns)).alias("position", "word"))
    words = words.select("id", "position", stem("word").alias("term"))
    if wanted is not None:
        only = wanted.select("term").distinct()
        few = only.limit(FEW_TERMS + 1).count() <= FEW_TERMS
        words = words.join(F.broadcast(only) if few else only, "term", "left_semi")
    return words.groupBy("id", "term").agg(F.array_sort(F.collect_list("position")).alias("positions"))


def asked_terms(df: DataFrame, query_id: str, query: str) -> DataFrame:
    """(query_id, phrase, place, term) of queries whose words all have to occur, those in quotes one after another."""
    part = r'"([^"]*)"|([^\s"]+)'
    quoted, bare = (F.regexp_extract_all(query, F.lit(part), F.lit(g)) for g in (1, 2))
    parts = df.select(F.col(query_id).alias("query_id"), F.posexplode(F.zip_with(quoted, bare, lambda q, b: F.when(q != "", q).otherwise(b))).alias("phrase", "part"))
    return parts.select("query_id", "phrase", F.posexplode(terms(F.col("part"))).alias("place", "word")).select("query_id", "phrase", "place", stem("word").alias("term"))


def ranked_matches(postings: DataFrame, asked: DataFrame, k: int = 100) -> DataFrame:
    """(query_id, id, covers, score, rank): the ``k`` best texts of each query that have all its terms, and its phrases.

    A cover is a shortest stretch of words with all terms of the query. A text's score sums over its covers 1, or NEAR
    over a cover's length where that is more. Ties (to nine places) by id. Queries without any word match nothing.
    """
    wanted = asked.select("query_id", "term").distinct()
    need = wanted.groupBy("query_id").agg(F.count("*").alias("need"))
    met = wanted.join(postings, "term")
    whole = met.groupBy("query_id", "id").agg(F.count("*").alias("have")).join(need, "query_id").where("have = need").select("query_id", "id", "need")

    sizes = asked.groupBy("query_id", "phrase").agg(F.count("*").alias("words")).where("words > 1")
    placed = asked.join(sizes, ["query_id", "phrase"]).join(postings, "term").select("query_id", "phrase", "words", "id", "place", F.explode("positions").alias("position"))
    begun = placed.groupBy("query_id", "phrase", "words", "id", (F.col("position") - F.col("place")).alias("start")).agg(F.count("*").alias("there"))
    said = begun.where("there = words").select("query_id", "phrase", "id").distinct().groupBy("query_id", "id").agg(F.count("*").alias("said"))
    phrases = sizes.groupBy("query_id").agg(F.count("*").alias("phrases"))
    whole = whole.join(phrases, "query_id", "left").join(said, ["query_id", "id"], "left").where(F.coalesce("said", F.lit(0)) == F.coalesce("phrases", F.lit(0)))

    # going through a text's places in order, with the latest place of each term: where the earliest of these moves on,
    # the stretch from it to here is a cover
    numbered = wanted.groupBy("query_id").agg(F.array_sort(F.collect_list("term")).alias("all")).select("query_id", F.posexplode("all").alias("t", "term"))
    entries = postings.join(numbered, "term").join(whole.select("query_id", "id", "need"), ["query_id", "id"])
    entries = entries.groupBy("query_id", "id", "need").agg(F.array_sort(F.flatten(F.collect_list(F.expr("transform(positions, p -> struct(p, t))")))).alias("places"))
    walk = f"""aggregate(places, named_struct('last', array_repeat(-1, int(need)), 'first', -1, 'covers', 0L, 'score', 0d), (s, x) -> named_struct(
      'last', transform(s.last, (v, i) -> if(i = x.t, x.p, v)),
      'first', array_min(transform(s.last, (v, i) -> if(i = x.t, x.p, v))),
      'covers', s.covers + if(array_min(transform(s.last, (v, i) -> if(i = x.t, x.p, v))) > s.first, 1L, 0L),
      'score', s.score + if(array_min(transform(s.last, (v, i) -> if(i = x.t, x.p, v))) > s.first, least(1d, {NEAR}d / (x.p - array_min(transform(s.last, (v, i) -> if(i = x.t, x.p, v))) + 1)), 0d)))"""
    scored = entries.withColumn("walked", F.expr(walk)).select("query_id", "id", F.col("walked.covers").alias("covers"), F.round("walked.score", 9).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "id", "covers", "score", "rank")
