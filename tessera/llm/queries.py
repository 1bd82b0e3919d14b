"""The operators of this subpackage as registered queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import embed_dedup, learned_ann, media, minhash, mixing, ngram_lm, quality, sentencepiece_codec, token_binary, toxicity, url_filter, variants, whitening
from .common import LOWER, UPPER, new_path, read_table


def op1_mix_sources(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op2_url_filters(spark, sf_dir):
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"))


def op3_toxicity(spark, sf_dir):
    return toxicity.classify_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_token_binary(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return token_binary.encoded_digests(docs, new_path(spark, "token-ids"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_media_fingerprints(spark, sf_dir):
    """The tables hold no audio, so every row of embeddings is rendered as a recording, one note a component."""
    return media.match_recordings(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", media.note_samples).withColumnRenamed("media_id", "vec_id")


def op6_quality_classifier(spark, sf_dir):
    return quality.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_embedding_near_dedup(spark, sf_dir):
    return embed_dedup.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op8_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.round_trips(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_lm_scores(spark, sf_dir):
    return ngram_lm.score_texts(read_table(spark, sf_dir, "documents"))


def op11_learned_neighbours(spark, sf_dir):
    return learned_ann.learned_neighbours(read_table(spark, sf_dir, "embeddings"))


def op12_whitening(spark, sf_dir):
    return whitening.whitened_vectors(read_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark, sf_dir):
    return variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def neighbours_of_all_parts(spark, sf_dir):
    """The learned partitions searched whole, which is exact and so has SQL."""
    found = learned_ann.learned_neighbours(read_table(spark, sf_dir, "embeddings"), recall=1.0)
    return found.select("query_id", "rank", "vec_id", F.round("score", 9).alias("score"))


def deviations(spark, sf_dir):
    """What SQL can say of whitening: the size of the fit list, and the whole deviations from its mean."""
    whole = whitening.whitened_vectors(read_table(spark, sf_dir, "embeddings"))
    return whole.where("component = 1").select("vec_id", "n", "deviation")


def vector_links(spark, sf_dir):
    """op7 on the table with perturbed copies of its vectors, at cosines from 0.86 to 0.999: it holds no links itself.

    ``exact`` says whether the graphs gave the result (false) or the comparison of all blocks.
    """
    vectors = read_table(spark, sf_dir, "embeddings")
    again = vectors.where("vec_id % 3 <> 0").select(F.col("vec_id").alias("of"), F.explode(F.array(F.lit(1), F.lit(2))).alias("k"), "embedding", "label").withColumn("new", F.expr("of * 4 + k"))
    moved = F.expr("transform(embedding, (c, i) -> cast(c as double) * (1d + ((of * 7 + new * 5 + i * 13) % 11 - 5) * (of % 8 + 1) * 0.02d))")
    rows = vectors.select((F.col("vec_id") * 4).alias("vec_id"), F.col("embedding").cast("array<double>"), "label").unionByName(again.select(F.col("new").alias("vec_id"), moved.alias("embedding"), "label"))
    return embed_dedup.near_duplicate_vectors(rows).select("vec_id", "n_links", "component_id", "kept", "exact")


def mix_targets(spark, sf_dir):
    """What SQL can say of the mix: sizes, and the targets of sources."""
    sized = mixing.document_sizes(read_table(spark, sf_dir, "documents"))
    targets = mixing.source_targets(sized)
    mixed = sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


def url_rules(spark, sf_dir):
    """What SQL can say of the URL filter: hosts, paths, and the rules that fit, with their verdicts."""
    pages = read_table(spark, sf_dir, "pages")
    urls = pages.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    return url_filter.match_rules(urls)


def host_ranks(spark, sf_dir):
    """Trust and distrust over links that the table has none of: each page's host links the next page's."""
    pages = read_table(spark, sf_dir, "pages")
    urls = url_filter.match_rules(pages.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path")))
    after = urls.select((F.col("page_id") - 1).alias("page_id"), F.col("host").alias("dst"))
    edges = urls.select("page_id", F.col("host").alias("src")).join(after, "page_id").where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    balance = urls.where("rule is not null").groupBy("host").agg(F.sum(F.when(F.col("rule_verdict") == "allow", 1).otherwise(-1)).alias("balance"))
    ranks = url_filter.propagate(edges, balance.where("balance > 0").select("host"), balance.where("balance < 0").select("host"))
    return ranks.select("host", F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))


_OPERATORS = (
    op1_mix_sources,
    op2_url_filters,
    op3_toxicity,
    op4_token_binary,
    op5_media_fingerprints,
    op6_quality_classifier,
    op7_embedding_near_dedup,
    op8_sentencepiece,
    op9_minhash_near_dedup,
    op10_lm_scores,
    op11_learned_neighbours,
    op12_whitening,
    op13_spelling_variants,
    neighbours_of_all_parts,
    deviations,
    mix_targets,
    url_rules,
    host_ranks,
    vector_links,
)
QUERIES = {f.__name__: f for f in _OPERATORS}

SHINGLE_COMPONENTS_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (SELECT w.doc_id, count(s.s) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY 1
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1) c ON c.doc_id = n.doc_id
"""

#: The level is the line through the last breakpoint at which the sources together still fit the budget.
MIX_TARGETS_SQL = r"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), t AS (SELECT source, sum(size) AS n FROM s GROUP BY 1
), r AS (SELECT *, 2.0::DOUBLE * n / w AS b FROM (SELECT *, ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM t)
), f AS (SELECT a.b, sum(least(2.0::DOUBLE * r.n, r.w * a.b)) AS f, sum(CASE WHEN r.b > a.b THEN r.w ELSE 0 END) AS w FROM (SELECT 0.0::DOUBLE AS b UNION SELECT b FROM r) a, r GROUP BY 1
), level AS (SELECT max_by(b + (1.5::DOUBLE * (SELECT sum(n) FROM r) - f) / w, b) AS level FROM f WHERE f <= 1.5::DOUBLE * (SELECT sum(n) FROM r) AND w > 0
)
SELECT s.doc_id, s.size, r.n::BIGINT AS source_size, round(least(2.0::DOUBLE * r.n, coalesce(r.w * level, 2.0::DOUBLE * r.n)), 6) AS target
FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source, level
"""

URL_RULES_SQL = rf"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), r AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/' WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM u)
SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS rule_verdict FROM r
"""

#: A step is linear in the ranks, so it is one join with a table of transitions: links, and what returns to the seeds.
HOST_RANKS_SQL = rf"""
WITH RECURSIVE u AS ({URL_RULES_SQL}), l AS (SELECT a.host AS src, b.host AS dst, count(*) AS w FROM u a JOIN u b ON b.page_id = a.page_id + 1 WHERE a.host <> '' AND b.host <> '' AND a.host <> b.host GROUP BY 1, 2
), e AS (SELECT 'trust' AS side, src, dst, w FROM l UNION ALL SELECT 'distrust', dst, src, w FROM l
), b AS (SELECT host, sum(CASE rule_verdict WHEN 'allow' THEN 1 ELSE -1 END) AS b FROM u WHERE rule IS NOT NULL GROUP BY 1
), s AS (SELECT *, count(*) OVER (PARTITION BY side) AS n FROM (SELECT host, CASE WHEN b > 0 THEN 'trust' ELSE 'distrust' END AS side FROM b WHERE b <> 0)
), h AS (SELECT side, host, bool_or(o) AS o FROM (SELECT side, src AS host, true AS o FROM e UNION ALL SELECT side, dst, false FROM e UNION ALL SELECT side, host, false FROM s) GROUP BY 1, 2
), t AS (SELECT side, src, dst, sum(p) AS p FROM (SELECT side, src, dst, 0.85::DOUBLE * w / sum(w) OVER (PARTITION BY side, src) AS p FROM e
    UNION ALL SELECT h.side, h.host, s.host, CASE WHEN h.o THEN 0.15::DOUBLE ELSE 1.0 END / s.n FROM h JOIN s ON s.side = h.side) GROUP BY 1, 2, 3
), r AS (SELECT 0 AS step, side, host, 1.0::DOUBLE / n AS rank FROM s
  UNION ALL SELECT r.step + 1, r.side, t.dst, sum(r.rank * t.p) FROM r JOIN t ON t.side = r.side AND t.src = r.host WHERE r.step < 150 GROUP BY 1, 2, 3)
SELECT host, round(sum(CASE side WHEN 'trust' THEN rank ELSE 0 END), 6) AS trust, round(sum(CASE side WHEN 'distrust' THEN rank ELSE 0 END), 6) AS distrust FROM r WHERE step = 150 GROUP BY 1
"""

#: Without any link there is nothing to audit, and the exact comparison gives the result.
VECTOR_COMPONENTS_SQL = """
WITH RECURSIVE links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r
), c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept,
  CASE WHEN (SELECT count(*) FROM links) > 0 THEN 1.0::DOUBLE END AS audit_recall, (SELECT count(*) FROM links) = 0 AS exact
FROM embeddings e JOIN c USING (vec_id)
"""

NEIGHBOURS_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM e q JOIN e c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 9) AS score FROM r WHERE rank <= 20
"""

DEVIATIONS_SQL = """
WITH w AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), d AS (SELECT DISTINCT x FROM w), n AS (SELECT count(*) AS n FROM d
), u AS (SELECT unnest(x) AS x, generate_subscripts(x, 1) AS i FROM d), s AS (SELECT i, sum(x)::BIGINT AS s FROM u GROUP BY i
), l AS (SELECT list(s ORDER BY i) AS s FROM s)
SELECT vec_id, n, list_sum(list_transform(range(1, len(x) + 1), lambda i: (n * x[i] - s[i]) * (n * x[i] - s[i])))::BIGINT AS deviation FROM w, n, l
"""

#: Found by comparing all vectors; exact = false asks that the graphs have found as much.
VECTOR_LINKS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id * 4 AS vec_id, embedding::DOUBLE[] AS embedding, label FROM embeddings
  UNION ALL SELECT vec_id * 4 + k, list_transform(range(1, len(embedding) + 1), lambda i: embedding[i]::DOUBLE * (1 + ((vec_id * 7 + (vec_id * 4 + k) * 5 + (i - 1) * 13) % 11 - 5) * (vec_id % 8 + 1) * 0.02::DOUBLE)), label
  FROM embeddings, (SELECT unnest([1, 2]) AS k) WHERE vec_id % 3 <> 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.embedding, b.embedding) >= 0.93
), reach AS (SELECT vec_id, vec_id AS r FROM v UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r
), c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY 1
), n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT c.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept, false AS exact FROM c LEFT JOIN n USING (vec_id)
"""

ORACLE_SQL = {
    "vector_links": VECTOR_LINKS_SQL,
    "neighbours_of_all_parts": NEIGHBOURS_SQL,
    "deviations": DEVIATIONS_SQL,
    "op7_embedding_near_dedup": VECTOR_COMPONENTS_SQL,
    "op9_minhash_near_dedup": SHINGLE_COMPONENTS_SQL,
    "mix_targets": MIX_TARGETS_SQL,
    "url_rules": URL_RULES_SQL,
    "host_ranks": HOST_RANKS_SQL,
}
