"""The pipeline's stages on a small corpus: what each must keep, and what comes out."""

import random
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402

import corpus_pipeline  # noqa: E402
from tessera.llm import quality, toxicity  # noqa: E402


@pytest.fixture(scope="module")
def corpus_dir(spark, tmp_path_factory):
    rnd = random.Random(21)
    folder = tmp_path_factory.mktemp("corpus")
    docs, labels = [], []
    for i in range(360):
        w = ["".join(rnd.choice(["ba", "ko", "ti", "se", "lu"]) for _ in range(3)) for _ in range(40)]
        bad, toxic = i % 6 == 0, i % 6 == 1
        if bad:
            w = [x.upper() + "!!" for x in w]
        if toxic:
            for m in rnd.sample(["rascal", "villain", "scoundrel", "knave"], 3):
                w[rnd.randrange(len(w))] = m
        docs.append((i, " ".join(w), "es", f"s{i % 3}", 1))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(1000 + i, docs[2][1] + f" more{i}", "es", "s0", 1) for i in range(5)] + [docs[3], (2000, None, None, None, None), *[(None, docs[k][1] + " odd one", "es", "s1", 1) for k in (2, 3, 4, 4)]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def ids(found):
    return [i for i in found if i is not None]


def test_stages(spark, corpus_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{corpus_dir}/documents.parquet")
    columns, now = docs.columns, docs
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, corpus_dir)
        rows = out.collect()
        now = spark.createDataFrame(rows, out.schema) if k < 4 else out
        kept.append([r["doc_id"] for r in rows])
        if k < 4:
            assert now.columns == columns
    good, clean, single, mixed, encoded = kept
    assert not {i for i in ids(good) if i < 360 and i % 6 == 0} and len({i for i in ids(good) if i < 360 and i % 6 != 0}) > 290
    assert not {i for i in ids(clean) if i < 360 and i % 6 == 1} and {i for i in ids(clean) if i % 6 not in (0, 1)} == {i for i in ids(good) if i % 6 not in (0, 1)}
    assert good.count(None) == 4 and single.count(None) == 0  # copies without an id go as any others
    assert {i for i in ids(single) if i >= 1000} <= {2000} and len(ids(single)) == len(set(ids(single))) and {i for i in ids(single) if i < 1000} == {i for i in ids(clean) if i < 1000}
    assert set(mixed) <= set(single) and max(mixed.count(i) for i in mixed if i is not None) <= 2
    assert sorted(encoded, key=str) == sorted(mixed, key=str)


def test_the_pipeline_is_what_plain_stages_give(spark, corpus_dir):
    """run() against the fitted models applied text by text, all pairs of shingle sets, the mix's limits and the library's ids."""
    from sentencepiece import SentencePieceProcessor
    from test_operators import brute_components, plain_quality_score, plain_toxic_score, water_level, words

    docs, labels = (spark.read.parquet(f"{corpus_dir}/{n}.parquet") for n in ("documents", "labels"))
    odds = quality.fit_quality(docs, labels)
    good = [r for r in docs.collect() if plain_quality_score(odds, r["text"] or "") >= 0.5]
    matcher, weights, coefficients = toxicity.fit_toxicity(spark.createDataFrame(good, docs.schema), labels)
    clean = [r for r in good if plain_toxic_score(matcher.terms, weights, coefficients, r["text"] or "") < 0.7]
    keys = {}
    for r in clean:  # rows without an id of their own are told apart by their texts
        keys.setdefault((r["doc_id"], r["text"]), r)
    rows = list(keys.values())
    part, _ = brute_components([(i, r["text"]) for i, r in enumerate(rows)])
    groups = Counter(part.values())

    out = corpus_pipeline.run(spark, corpus_dir).collect()
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain_ids = {}
    for i, r in enumerate(rows):
        plain_ids.setdefault((r["doc_id"], r["source"], tuple(library.encode(r["text"] or ""))), part[i])
    met = Counter()
    for r in out:
        assert (r["doc_id"], r["source"], tuple(r["ids"])) in plain_ids and r["n_tokens"] == len(r["ids"])
        met[plain_ids[r["doc_id"], r["source"], tuple(r["ids"])], r["doc_id"]] += 1
    assert len({g for g, _ in met}) == len(met) and set(met.values()) <= {1, 2}  # one of each group, at most twice
    assert len(groups) - len(met) <= 0.25 * len(groups)  # rates near one leave few out
    single = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(clean, docs.schema), corpus_dir).collect()
    assert len(single) == len(groups)
    sizes, taken = Counter(), Counter()
    for r in single:
        sizes[r["source"]] += len(words(r["text"]))
    size_of = {(r["doc_id"], r["source"]): len(words(r["text"])) for r in single}
    for r in out:
        taken[r["source"]] += size_of[r["doc_id"], r["source"]]
    for source, target in water_level(sizes, (3, 1, 2), 1.5, 2.0).items():
        assert abs(taken[source] - target) <= 45, source  # texts have some 40 words


def test_near_copies_of_rows_without_an_id_of_their_own(spark):
    """Rows without an id and rows that share one are documents by their texts; one of each group stays, the same at every run."""
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(900)}" for _ in range(40)) for _ in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[1] + " end"), (None, texts[2]), (None, texts[2]), (7, texts[3]), (8, texts[3] + " end"), (None, None), (9, ""), (10, "")]
    docs = spark.createDataFrame([(i, t, "es", None, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(docs.where("doc_id = 1").withColumn("lang", corpus_pipeline.F.lit("fr")))
    kept = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert kept.count((1, texts[0], "es", None, 1)) == 1 and not [r for r in kept if r[2] == "fr"]
    group = [r for r in kept if r[1] and r[1].startswith(texts[1])]
    assert len(group) == 1 and sum(r[1] == texts[2] for r in kept) == 1
    assert {r[0] for r in kept if r[0] and r[0] > 1} == {7, 9, 10} and len(kept) == 7
    again = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs.repartition(5), "").collect()]
    assert sorted(map(str, kept)) == sorted(map(str, again))


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() == 0
