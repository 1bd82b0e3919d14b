"""Spanish full text against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import folded
from tessera.operators import fulltext


def plain_stem(word):
    for pattern in fulltext.ending_patterns():
        word = re.sub(pattern, r"\1", word)
    return word


def plain_search(texts, query):
    """{id: (covers, score)} of one query."""
    parts = [[plain_stem(w) for w in re.findall(r"[a-z0-9]+", folded(q or b))] for q, b in re.findall(r'"([^"]*)"|([^\s"]+)', query)]
    wanted = {w for p in parts for w in p}
    out = {}
    for i, text in texts.items():
        words = [plain_stem(w) for w in re.findall(r"[a-z0-9]+", folded(text))]
        if not wanted or not wanted <= set(words) or not all(any(words[k : k + len(p)] == p for k in range(len(words))) for p in parts):
            continue
        covers = [(a, b) for a in range(len(words)) for b in range(a, len(words)) if wanted <= set(words[a : b + 1]) and not (b > a and (wanted <= set(words[a + 1 : b + 1]) or wanted <= set(words[a:b])))]
        out[i] = (len(covers), round(sum(min(1.0, fulltext.NEAR / (b - a + 1)) for a, b in covers), 9))
    return out


@pytest.mark.parametrize("words", [("notificaciones", "notificación"), ("constitucional", "constitucionales"), ("derecho", "derechos"), ("juzgado", "juzgada"), ("violaban", "violaron"), ("administrativa", "administrativos")])
def test_forms_share_a_stem(spark, words):
    got = spark.createDataFrame([(w,) for w in words], "w string").select(fulltext.stem(F.translate("w", "óí", "oi")).alias("s")).distinct().collect()
    assert len(got) == 1 and len(got[0]["s"]) >= fulltext.LEAST_STEM


def test_search(spark):
    rnd = random.Random(5)
    vocabulary = ["Ley", "leyes", "amparo", "amparos", "de", "la", "Notificación", "notificaciones", "juez", "jueces", "x1"]
    texts = {i: " ".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", " - "]) for _ in range(rnd.randrange(0, 60))) for i in range(60)}
    rows = [*texts.items(), (100, None), (101, ""), (None, "Ley de amparo"), (102, "ley " + "de " * 20_000 + "amparo")]
    texts[102] = rows[-1][1]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("term", F.lit("clash"))
    queries = {1: "ley amparo", 2: '"ley de amparo"', 3: '"de la" NOTIFICACIÓN "jueces"', 4: "", 5: "inexistente ley", 6: '"la la" la', 7: "juez"}
    asked = fulltext.asked_terms(spark.createDataFrame([*queries.items(), (8, None)], "q long, text string"), "q", "text")
    got = {}
    for r in fulltext.ranked_matches(fulltext.positional_postings(df, "id", "text"), asked, 1000).collect():
        got.setdefault(r["query_id"], {})[r["id"]] = (r["covers"], r["score"])
    texts.pop(102)
    long = {q: v.pop(102, None) for q, v in got.items()}
    assert long[1] == (1, round(fulltext.NEAR / 20_002, 9))
    for q, text in queries.items():
        assert got.get(q, {}) == plain_search(texts, text), text
    assert fulltext.positional_postings(df.limit(0), "id", "text").count() == 0


def test_wanted_stems_alone_are_posted(spark):
    """What isn't asked doesn't leave the texts, and positions still count every word."""
    df = spark.createDataFrame([(1, "la casa de las casas"), (2, "nada"), (None, "casa")], "id long, t string")
    wanted = spark.createDataFrame([("cas",), ("cas",)], "term string")
    got = fulltext.positional_postings(df, "id", "t", wanted=wanted).collect()
    assert [(r["id"], r["term"], r["positions"]) for r in got] == [(1, "cas", [1, 4])]
