"""One scan against a scan for each pattern, and citations resolved against plain loops."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import catalog, citations


@pytest.mark.parametrize("pattern, heads", [(r"C[oó]digo\s+Penal", ["codigo", "código"]), (r"Convenci[oó]n\s+A(?:x)?|Pacto\s+de", ["convencion", "convención", "pacto"]), (r"(?:a|b)c", None), (r"Le?y", None), (r"Ley+", ["ley"]), (r"ley\.?", ["ley"]), (r"x|abc", None)])
def test_literal_heads(pattern, heads):
    assert citations.literal_heads(pattern) == heads


def test_scan_is_a_scan_for_each_pattern():
    patterns = [*catalog.LAWS.values(), *catalog.TREATIES.values(), r"\d{4}", r"aba", r"(?:ley|art)\w*", r"ley\s+ley"]
    rnd = random.Random(3)
    pieces = ["Ley", "ley  de\tAmparo", "LEY FEDERAL DEL TRABAJO", "Código de", "Comercio", "ConstituciÓn PolÍtica", "de los Estados Unidos Mexicanos", "Pacto de San José", "ababa", "1999", "ſ", "İ", "Conſtitución política", "ley\nley ley", "CÓDIGO PENAL FEDERAL", "Convención contra la Tortura", " ", "日本"]
    for caseless in (True, False):
        scan = citations.PatternScan(patterns, caseless)
        for _ in range(300):
            text = "".join(rnd.choice(pieces) + rnd.choice(["", " ", "  ", "\n"]) for _ in range(rnd.randrange(12)))
            want = sorted((i, m.start(), m.end()) for i, p in enumerate(patterns) for m in re.finditer(p, text, re.I if caseless else 0))
            assert scan.matches(text) == want, text


def test_windows_of_odd_texts(spark):
    rows = [(1, "Ley de Amparo, artículo 5"), (1, "Ley de Amparo, artículo 5"), (None, "art. 3 Ley de Amparo"), (4, None), (5, ""), (6, "x" * 200_000 + " Ley de Amparo art. 9 " + "y" * 200_000)]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("code", F.lit("clash"))
    got = sorted((r["id"] is None, r["id"], r["law_pos"], r["articulo"]) for r in citations.citation_windows(df, "id", "text", catalog.LAWS).collect())
    assert got == [(False, 1, 0, "5"), (False, 1, 0, "5"), (False, 6, 200_001, "9"), (True, None, 7, "3")]
    assert citations.citation_windows(df.limit(0), "id", "text", catalog.LAWS).count() == 0


def test_resolution(spark):
    day = datetime.date
    docs = [(1, "2a./J. 19/2021 (11a.)", day(2021, 1, 1)), (2, "1a./J. 19/2021 (11a.)", day(2021, 2, 1)), (3, "2a./J. 19/2021", None), (4, "I.6o.P.88 P (10a.)", None), (5, None, None), (6, " ", None), (7, "2a./J. 19/2021 (11a.)", day(2022, 1, 1))]
    targets = citations.case_targets(spark.createDataFrame(docs, "d long, clave string, fecha date"), "d", "clave", "fecha")
    laws = citations.law_targets(spark.createDataFrame([(50, "  Ley de  Amparo, reformada"), (51, "LEY DE AMPARO"), (52, "Sobre la Ley de Amparo"), (53, None)], "d long, titulo string"), "d", "titulo")
    asked = [(1, "tesis", "2a./J. 19/2021  (11a.)"), (2, "tesis", "J. 19/2021"), (3, "tesis", "2A/J 19/2021 (10a.)"), (4, "tesis", "i.6o.p. 88 p"), (5, "tesis", "9a./J. 1/1999"), (6, "tesis", None), (7, "tesis", ""), (8, "ley", "LA"), (9, "ley", "CFF"), (1, "tesis", "2a./J. 19/2021  (11a.)")]
    cites = spark.createDataFrame(asked, "n long, kind string, cited string").withColumn("block", F.lit("clash"))
    found = citations.resolve_citations(cites, targets.unionByName(laws)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["n"], r["candidate"])):
        got.setdefault(r["n"], []).append(r["cited_doc_id"])
        assert r["candidates"] == len({x["cited_doc_id"] for x in found if x["n"] == r["n"] and x["cited_doc_id"] is not None})
    assert got[1] == [7, 7, 1, 1, 3, 3]  # the repeated row has its own
    assert got[2] == [7, 2, 1, 3]
    assert got[3] == [3] and got[4] == [4] and got[8] == [50, 51]
    assert got[5] == got[6] == got[7] == got[9] == [None]
    assert {r["n"]: r["norm_canon"] for r in found}[7] is None and {r["n"]: r["norm_canon"] for r in found}[5] == "9A/J1/1999"
    assert citations.resolve_citations(cites, targets.limit(0)).where("candidates > 0").count() == 0


def test_best_candidate_meets_citations_alone(spark):
    """Many documents bear one law; with ``best`` each citation is one row, with as many candidates counted."""
    targets = spark.createDataFrame([("ley", "X", None, None, i, None) for i in range(50)], "kind string, block string, organ string, epoch string, doc_id long, date date")
    cites = spark.createDataFrame([("ley", "X", 1), ("ley", "X", 2), ("ley", "Y", 3)], "kind string, cited string, n int")
    got = citations.resolve_citations(cites, targets, best=True).orderBy("n").collect()
    assert [(r["n"], r["cited_doc_id"], r["candidate"], r["candidates"]) for r in got] == [(1, 0, 1, 50), (2, 0, 1, 50), (3, None, 1, 0)]
    assert citations.resolve_citations(cites, targets).count() == 101


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from tessera.operators.batches import small_batches

    batch = pa.RecordBatch.from_pydict({"i": list(range(100)), "t": ["x" * 1000] * 100})
    parts = list(small_batches(iter([batch, batch.slice(0, 0)]), 10_000))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(100)) and max(p.num_rows for p in parts) <= 10
