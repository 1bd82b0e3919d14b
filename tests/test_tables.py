"""Chunks, corpus, writes, matching, retrieval, audits, plans and streams."""

import datetime
import math
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.vectors import cosine
from tessera.operators import audit, chunk, corpus, match, retrieval, upsert
from tessera.plans import paging
from tessera.queries import QUERIES
from tessera.sources import readers, writers
from tessera.streaming import incremental


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: [(x is not None, x) for x in r])


def test_paragraph_orders(spark):
    text = "\n\n".join(("x" * 100 if i % 2 else "y") for i in range(250))
    one = spark.createDataFrame([(1, text)], "id long, t string")
    assert one.select(F.size(chunk.paragraphs(F.col("t"), most=200))).first()[0] == 125
    assert one.select(F.size(chunk.paragraphs(F.col("t"), most=50, cap_first=True))).first()[0] == 25
    assert spark.createDataFrame([("a\n\nb\n \nc",)], "t string").select(chunk.paragraphs(F.col("t"), more_than=0)).first()[0] == ["a", "b", "c"]


def test_article_split(spark):
    t = "pre Artículo 1. cuerpo uno largo, de más de treinta letras ARTÍCULO 2 Bis. no se corta Artículo 3. x"
    got = spark.createDataFrame([(t,), ("sin marcas",), (None,)], "t string").select(chunk.marked_sections(F.col("t")).alias("c")).collect()
    assert [c["text"][:30] for c in got[0]["c"]] == ["Artículo 1. cuerpo uno largo, "]
    assert [(c["type"], c["text"]) for c in got[1]["c"]] == [("cuerpo", "sin marcas")]


def test_chunk_gaps(spark):
    df = spark.createDataFrame([(1, ["a", "  ", "b"])], "id long, t array<string>").select("id", chunk.pieces("p", F.col("t")).alias("c"))
    assert [r["chunk_index"] for r in chunk.explode_chunks(df, "id", "c").collect()] == [0, 2]
    assert [r["chunk_index"] for r in chunk.explode_chunks(df, "id", "c", keep_gaps=False).collect()] == [0, 1]


def test_cuts_at_white_space(spark):
    """A body cut in the middle of white space keeps it, as its SQL does; a text without markers is stripped."""
    df = spark.createDataFrame([(1, "pre\nUno " + "ab " * 2000), (2, " sin marca ")], "doc_id long, text string")
    parts = df.select("doc_id", chunk.marked_sections(F.col("text"), r"\n(\p{Lu}\p{Ll}*) ", cut=3).alias("c"))
    assert rows(chunk.explode_chunks(parts, "doc_id", "c", trim=False), "doc_id", "text", "char_count") == [(1, "Artículo Uno. ab ", 17), (2, "sin marca", 9)]
    assert rows(chunk.explode_chunks(parts, "doc_id", "c"), "doc_id", "text") == [(1, "Artículo Uno. ab"), (2, "sin marca")]


def test_marked_sections_are_whole(spark, tmp_path):
    """Neither long bodies nor a long text without markers are cut, by the operator and by the query."""
    long = "palabra " * 2000
    df = spark.createDataFrame([(1, f"pre\nUno {long}\nDos {long}fin"), (2, f" {long}sin marca ")], "doc_id long, text string")
    parts = df.select("doc_id", chunk.marked_sections(F.col("text"), r"\n(\p{Lu}\p{Ll}*) ").alias("c"))
    whole = [(1, f"Artículo Uno. {long.strip()}"), (1, f"Artículo Dos. {long}fin"), (2, f"{long}sin marca")]
    assert rows(chunk.explode_chunks(parts, "doc_id", "c"), "doc_id", "text") == sorted(whole)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(QUERIES["chunk_split_marker"](spark, str(tmp_path)), "doc_id", "chunk_type", "n", "chars")
    assert got == [(1, "articulo", 2, len(whole[0][1]) + len(whole[1][1])), (2, "cuerpo", 1, len(whole[2][1]))]


def test_index_tasks_grow_in_number(spark, tmp_path, monkeypatch):
    """Texts of more characters than a task and a piece hold are dealt to more of them, and searches find the same."""
    df = spark.createDataFrame([(i, f"uno dos w{i % 7}") for i in range(60)], "id long, t string")
    found = {}
    for piece in (1 << 26, 100):
        monkeypatch.setattr(retrieval.LexicalIndex, "PIECE", piece)
        monkeypatch.setattr(retrieval.LexicalIndex, "TASK", piece)
        index = retrieval.LexicalIndex(spark, f"{tmp_path}/{piece}")
        index.refresh(df, "id", ["t"])
        found[piece] = rows(index.search({"q": "uno w3"}), "query_id", "id", "score", "rank")
    few, many = found.values()
    assert few == many and len(few) == 9


def test_sources_keep_their_long_texts(spark):
    """The filler of the sources' table isn't the one that another query has under the same name."""
    from tessera import queries

    built = queries.QUERIES["corpus_sources"](spark, "/root/testdata/sf0.001").where("native in ('serie-3-numero-3', 'id_engrose-3')")
    ends = [r["chunks"].split("-3-")[-1] for r in built.collect()]
    assert ends == ["x" * 100] * 2


def test_every_source_builds(spark):
    """All specifications resolve against tables that have their columns."""
    columns = {
        "scjn_tesis": "registro_digital long, rubro string, titulo string, tipo string, epoca_numero string, epoca_nombre string, clave string, fuente string, instancia string, organo_jurisdiccional string, fecha_publ_semanario string, texto_contenido string, texto_hechos string, texto_justificacion string, texto_criterios_juridicos string, detail_fetched_at string",
        "scjn_historica": "ius long, rubro string, localizacion string, epoca string, instancia string, tipo_tesis string, texto string",
        "tfja": "id_tfja long, epoca string, sala string, clave string, materia string, rubro string, texto string, precedente_raw string, ponente string, revista_ref string, anio_revista int, status string",
        "sre_tratado": "token_sre string, nombre string, categoria string, tema string, estatus string, lugar_adopcion string, fecha_vigor_mexico string, publ_dof_promulgacion string, aprobacion_senado string, tramite_constitucional string, notas string, tipo string, reservas string, detail_fetched_at string",
        "corte_idh": "serie string, numero int, url string, nombre string, pais string, fecha_sentencia string, anio int, tipo string, raw_text string, status string",
        "dip_ley": "law_id long, nombre string, abreviatura string, ultima_reforma string, categoria string, primary_url string, texto string",
        "scjn_ejecutoria": "registro_digital long, num_expediente string, asunto string, ponente string, secretario string, fecha_resolucion string, organo_jurisdiccional string, tipo_asunto string, votacion string, texto string, status string",
        "scjn_voto": "registro_digital long, tipo_voto string, ministro string, num_expediente string, organo string, fecha string, texto string, status string",
        "scjn_acuerdo": "id_native string, rubro string, fuente string, fechaPublicacionSemanario string, instancia string, organoJurisdiccional string",
        "scjn_vtaquigrafica": "id_native string, organoJurisdiccional string, fechaSesion string, instancia string, anio int",
        "scjn_voto_sentencia": "id_native string, ministroFirma string, tipoVoto string, expediente string, asuntoId long, textoVoto string, fechaCierreCompleto string, tipoAsunto string",
        "bj_legislacion": "id_native string, ordenamiento string, vigencia string, estado string, fechaPublicado string, materia string, ambito string, pais string",
        "scjn_sentencia": "id_engrose long, num_expediente string, tipo_asunto string, organo_radicacion string, ponente string, fecha_resolucion string, anio int, votacion string, epoca_numero string, epoca_nombre string, fuente string, archivo_url string, sections array<struct<type:string,text:string>>, body_html string",
        "scjn_biblioteca": "id_native string, titulo string, resumen string, autor string, tema string, coleccion string, urlPrimo string",
        "scjn_expediente": "id_native string, expediente string, fechaResolucion string, tema string, tipoAsunto string, materias string, pertenencia string, estado string",
    }
    assert set(columns) == set(corpus.SOURCES)
    tables = {}
    for name, ddl in columns.items():
        kinds = [c.strip().split(" ", 1) for c in ddl.split(", ")] if "struct" not in ddl else None
        if kinds:
            cells = tuple("ok" if n == "status" else 7 if k in ("long", "int") else f"{n} " * 30 for n, k in kinds)
        else:
            cells = (7, "1/2", "Amparo", "Pleno", "P", "13/08/2025", 2025, "v", "1", None, "f", "u", None, "<p>cuerpo de la sentencia</p>")
        tables[name] = spark.createDataFrame([cells], ddl)
    built = corpus.build_corpus(tables)
    assert built.count() == 15 and built.select("doc_id").distinct().count() == 15
    chunks = corpus.corpus_chunks(built)
    assert chunks.select("doc_id").distinct().count() == 15
    judged = built.where("source = 'scjn_sentencia'").first()
    assert [c["type"] for c in judged["chunks"]] == ["titulo", "cuerpo"] and judged["fecha_emision"] == datetime.date(2025, 8, 13)
    assert built.where("source = 'bj_legislacion'").first()["jerarquia"] == "estatal"
    assert corpus.build_corpus(tables, compat=True).where("source = 'scjn_sentencia'").first()["fecha_emision"] == "13/08/2025"


def test_write_semantics(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k long, v string, w string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", None)], "k long, v string, w string")
    assert rows(upsert.last_wins(old, new, ["k"], "v"), "k", F.coalesce("v", F.lit("-"))) == [(1, "a"), (2, "-"), (3, "c")]
    assert rows(upsert.first_wins(old, new, ["k"]), "k", F.coalesce("v", F.lit("-"))) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(upsert.keep_old_if_null(old, new, ["k"]), "k", "v", F.coalesce("w", F.lit("-"))) == [(1, "a", "-"), (2, "b", "y"), (3, "c", "-")]
    assert rows(upsert.keep_old_if_null(old, new, ["k"], always=("v",)), "k", F.coalesce("v", F.lit("-"))) == [(1, "a"), (2, "-"), (3, "c")]
    assert rows(upsert.replace_children(old, new, "k"), "k") == [(1,), (2,), (3,)]
    nulls = spark.createDataFrame([(None, "p"), (None, "q")], "k long, v string")
    assert upsert.first_wins(nulls.limit(0), nulls, ["k"], "v").count() == 1
    assert upsert.first_wins(nulls.limit(0), nulls, ["k"], "v", compat=True).count() == 2
    assert rows(upsert.capped(old, {"v": 0}), "v") == [("",), ("",)]


def test_prefix_overlap_against_loops(spark):
    rnd = random.Random(1)
    left = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(6))) for _ in range(20)]
    right = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(8))) for _ in range(40)]
    got = match.prefix_overlap(spark.createDataFrame([(i, t) for i, t in enumerate(left)], "i long, t string"), spark.createDataFrame([(t,) for t in right], "t string"), "t", 4)
    assert rows(got, "i", "hits") == [(i, sum(r.startswith(t[:4]) for r in right) if t else 0) for i, t in enumerate(left)]


def test_bm25_is_fts5(spark):
    """The same rows and scores as SQLite's full-text search gives."""
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice(["interés", "superior", "menor", "ley", "de", "agua"]) for _ in range(rnd.randrange(1, 30)))) for i in range(60)]
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table f using fts5(t, tokenize='unicode61 remove_diacritics 2')")
    con.executemany("insert into f(rowid, t) values (?, ?)", docs)
    df = spark.createDataFrame(docs, "id long, t string")
    for q in ("interes menor", "agua", "no está"):
        want = con.execute("select rowid, rank from f where f match ? order by rank, rowid", (" ".join(retrieval.query_terms(q)),)).fetchall()
        got = {r["id"]: r["score"] for r in retrieval.bm25(df, "id", ["t"], q).collect()}
        assert got.keys() == {i for i, _ in want} and all(math.isclose(got[i], s, abs_tol=1e-8) for i, s in want)
    index, sizes = retrieval.postings(df, "id", "t"), df.select("id", F.size(retrieval.terms("t")).alias("dl"))
    asked = spark.createDataFrame([(1, "interes"), (1, "menor")], "query_id long, term string")
    stored = {r["id"]: r["score"] for r in retrieval.bm25_of_postings(index, sizes, asked).collect()}
    assert stored == {r["id"]: r["score"] for r in retrieval.bm25(df, "id", ["t"], "interés menor").collect()}


def test_query_text_is_no_syntax():
    assert retrieval.query_terms("art. 8.4 CADH") == ["art", "8", "4", "cadh"]


def test_folding_is_the_same_on_both_sides(spark):
    df = spark.createDataFrame([(1, "Čapek ő ﬃ NIÑO"), (2, "capek"), (3, "ĀB n\u0303")], "id long, t string")
    for q in ("Čapek", "čapek", "capek", "ő", "ﬃ", "niño"):
        assert [r["id"] for r in retrieval.bm25(df, "id", ["t"], q).orderBy("id").collect()] == ([1, 2] if "apek" in q else [1]), q
    assert [r["id"] for r in retrieval.bm25(df, "id", ["t"], "āb ñ").collect()] == [3]


def test_stored_index(spark, tmp_path):
    """Refreshed in steps it is what all rows at once give; a batch whose sizes were never written doesn't count."""
    df = spark.createDataFrame([(i, f"agua {'ley ' * (i % 5)} n{i}") for i in range(40)] + [(None, "agua")], "id long, t string")
    index = retrieval.LexicalIndex(spark, str(tmp_path / "index"))
    assert index.search({"a": "agua"}).count() == 0
    index.refresh(df.where("id < 15"), "id", ["t"])
    index.refresh(df, "id", ["t"])
    index.refresh(df, "id", ["t"])
    retrieval.postings(df.limit(5), "id", "t").withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(str(tmp_path / "index/generation=0/postings/batch=lost"))
    got = {(r["query_id"], r["id"]): r["score"] for r in index.search({"a": "agua ley", "b": "n7", "c": "nada"}).collect()}
    plain = {("a", r["id"]): r["score"] for r in retrieval.bm25(df.where("id is not null"), "id", ["t"], "agua ley").collect()}
    assert {k: v for k, v in got.items() if k[0] == "a"} == plain and {k for k in got if k[0] != "a"} == {("b", 7)}
    plan = index.postings(["agua"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_index_of_changed_and_removed_rows(spark, tmp_path):
    """After changes, removals and merges searches find what a new index of the same rows finds."""
    rnd = random.Random(9)
    texts = {i: " ".join(rnd.choice(["agua", "ley", "pan", "sol", f"n{i}"]) for _ in range(12)) for i in range(40)}

    def frame(rows):
        return spark.createDataFrame(list(rows), "id long, t string")

    def found(index):
        return {(r["query_id"], r["id"]): r["score"] for r in index.search({"a": "agua ley", "b": "n7", "c": "nuevo"}).collect()}

    index = retrieval.LexicalIndex(spark, str(tmp_path / "index"))
    index.merge()  # of nothing
    index.refresh(frame(texts.items()), "id", ["t"])
    for i in (3, 7, 8):
        texts[i] = "nuevo agua ley"
    texts[50] = "nuevo"
    index.refresh(frame(texts.items()), "id", ["t"])
    for i in (3, 20, 21):
        del texts[i]
    index.remove(frame([(3, ""), (20, ""), (21, ""), (999, "")]), "id")
    fresh = retrieval.LexicalIndex(spark, str(tmp_path / "fresh"))
    fresh.refresh(frame(texts.items()), "id", ["t"])
    want = found(fresh)
    assert found(index) == want and ("c", 7) in want and ("b", 7) not in want
    index.merge()
    assert found(index) == want and index._entries().select("batch").distinct().count() == 1
    index.refresh(frame([(20, "nuevo otra vez")]), "id", ["t"])  # removed before, and back
    assert ("c", 20) in found(index)


def test_vectors_of_other_lengths_and_values(spark, monkeypatch):
    """Only vectors of a query's length count; blocks of any size give the same."""
    rnd = random.Random(6)
    rows_ = [(i, [rnd.gauss(0, 1) for _ in range(3 if i % 3 else 2)]) for i in range(60)]
    rows_ += [(60, [1.0, None]), (61, [float("nan"), 1.0]), (62, [float("inf"), 1.0]), (63, []), (64, None), (None, [1.0, 2.0]), (65, [0.0, 0.0]), (66, rows_[0][1])]
    df = spark.createDataFrame(rows_, "id long, v array<double>")
    want = None
    for sizes in ((4096, 16, 2048), (4, 2, 3)):
        for name, n in zip(("VECTOR_BLOCK", "TOGETHER", "QUERY_BLOCK"), sizes, strict=True):
            monkeypatch.setattr(retrieval, name, n)
        got = sorted((r["query_id"], r["id"], round(r["score"], 9), r["rank"]) for r in retrieval.cosine_topk(df, df, "id", "v", k=4).collect())
        want = want or got
        assert got == want
    length = {i: len(v) for i, v in rows_[:60]} | {65: 2, 66: 2}
    assert {q for q, *_ in got} == set(length) and all(length[q] == length[i] and q != i for q, i, *_ in got)
    assert (0, 66, 1.0, 1) in got and len(got) == 4 * len(length)


def test_cosine_blocks(spark):
    rnd = random.Random(2)
    vectors = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(50)] + [(50, None)]
    df = spark.createDataFrame(vectors, "id long, v array<float>")
    got = retrieval.cosine_topk(df, df.where("id % 10 = 0"), "id", "v", k=5)
    assert got.count() == 25
    best = {r["query_id"]: r["id"] for r in got.where("rank = 1").collect()}

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))

    assert best == {q: max((i for i, v in vectors[:50] if i != q), key=lambda i: cos(vectors[q][1], vectors[i][1])) for q in range(0, 50, 10)}


def test_audits(spark):
    df = spark.createDataFrame([("a" * 49, 1), ("a" * 50, None), ("a" * 51, 2), (None, 2)], "t string, g int")
    r = audit.text_presence(df, "t").first()
    assert (r["with_text"], r["without_text"], r["very_short"]) == (1, 2, 1)
    assert audit.null_profile(df).first().asDict() == {"n_rows": 4, "t_nulls": 1, "g_nulls": 1}
    assert [tuple(x) for x in audit.distribution(df, "g").collect()] == [(2, 2), (None, 1), (1, 1)]
    assert rows(audit.seeded_sample(df, "g", 2), "g") == rows(audit.seeded_sample(df, "g", 2), "g")


def test_page_plan_and_days(spark):
    plan = paging.page_plan(spark.createDataFrame([("a", 17498), ("b", 0), ("c", 51)], "slice string, total long"), "total")
    assert rows(plan.groupBy("slice").agg(F.max("page")), "*") == [("a", 200), ("c", 2)]
    assert paging.days(spark, "2024-02-28", "2024-03-01").count() == 3
    assert paging.candidates(spark.createDataFrame([(2020, 2), (2021, 2), (2022, None), (2023, 0)], "y int, m int"), "y", "m", ["{year}/{n}", "{year}/{n}", "x{n}"]).count() == 6


def test_runs_and_stops(spark):
    df = spark.createDataFrame([(i, i in (0, 3)) for i in range(10)], "n int, hit boolean")
    assert [r["misses"] for r in incremental.run_lengths(df, None, "n", "hit").orderBy("n").collect()] == [0, 1, 2, 0, 1, 2, 3, 4, 5, 6]
    assert incremental.stop_place(df, "n", "hit", 3, 5).first()["stop_at"] == 6
    rnd = random.Random(1)
    hits = [(3 * i, rnd.random() < 0.15) for i in range(120)]
    many, run, want = spark.createDataFrame(hits, "n int, hit boolean"), 0, []
    for _, hit in hits:
        run = 0 if hit else run + 1
        want.append(run)
    for block in (1, 7, 40, 10**6):  # blocks without a hit, and of one row
        assert [r["misses"] for r in incremental.run_lengths(many, None, "n", "hit", block).orderBy("n").collect()] == want


def test_file_batches(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    spark.range(10).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        incremental.process_new_files(spark, source, "id long", lambda df, n: seen.append(df.count()), str(tmp_path / "ck")).awaitTermination()
    spark.range(5).write.mode("append").parquet(source)
    incremental.process_new_files(spark, source, "id long", lambda df, n: seen.append(df.count()), str(tmp_path / "ck")).awaitTermination()
    assert sum(seen) == 15
    writer, out = incremental.batch_writer(str(tmp_path / "out"), lambda df: df.where("id < 3")), str(tmp_path / "out")
    for number in (0, 0, 1):  # a batch that comes again replaces itself
        writer(spark.range(10), number)
    assert spark.read.parquet(out).count() == 6


def test_stream_of_events(spark, tmp_path):
    data = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, m), "a", k) for m, k in ((1, 1), (2, 1), (12, 2))], "ts timestamp, kind string, k long")
    data.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    counted = incremental.windowed_counts(incremental.distinct_events(stream, "ts", "k"), "ts", ["kind"], late=None)
    q = counted.writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination()
    assert spark.sql("select count(*) from counts").first()[0] <= 2


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>" + "x" * 600)
    (tmp_path / "b.html").write_text("short")
    assert readers.html_files(spark, f"{tmp_path}/*.html").count() == 1
    (tmp_path / "d.pdf").write_bytes(b"%PDF-" + b"0" * 3000)
    (tmp_path / "e.pdf").write_bytes(b"<html>" + b"0" * 3000)
    pdfs = readers.binary_documents(spark, f"{tmp_path}/*.pdf")
    assert pdfs.count() == 1
    assert readers.extracted_text(pdfs, lambda data, pages: data[:5].decode()).first()["text"] == "%PDF-"
    writers.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), str(tmp_path / "t"), "k")
    writers.replace_partitions(spark.createDataFrame([(2, "c")], "k int, v string"), str(tmp_path / "t"), "k")
    assert rows(spark.read.parquet(str(tmp_path / "t")), "k", "v") == [(1, "a"), (2, "c")]
    (tmp_path / "p.json").write_text('{"pagina": 1, "resultados": [{"id": 1}, {"id": 2}]}')
    assert readers.listings(spark, str(tmp_path / "p.json"), "pagina int, resultados array<struct<id:long>>").count() == 2


def test_small_sinks_and_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, "uno\ndos", "", ["a", "b"])], "k int, v string, e string, m array<string>")
    path = str(tmp_path / "t")
    writers.reload_table(df.unionByName(df), path)
    writers.reload_table(df, path)
    writers.append_log(df, path)
    assert spark.read.parquet(path).count() == 2
    writers.json_report(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["v"] == "uno\ndos"
    r = df.select(tx.or_else("e", "v").alias("o"), tx.join_names("m").alias("j"), tx.truncated("v", 3).alias("t"), *[c.alias(n) for c, n in zip(retrieval.preview(F.col("e"), F.col("v"), F.col("v")), "ab", strict=True)]).first()
    assert tuple(r) == ("uno\ndos", "a, b", "uno", "uno\ndos", "uno dos")
    vectors = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert vectors.select(cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(2**-0.5)
    plan = spark.createDataFrame([("a", 1, 50), ("a", 2, 50), ("a", 3, 50)], "slice string, page int, size int")
    ledger = spark.createDataFrame([("a", 1, 50, 10), ("a", 2, 50, 0), ("a", 3, 20, 9)], "slice string, page int, size int, count int")
    assert rows(incremental.incomplete_pages(plan, ledger, ["slice", "page"]), "page") == [(2,), (3,)]
    found = spark.createDataFrame([(1, "x")], "k int, r string")
    hit, miss = readers.records_of(spark.createDataFrame([(1,), (2,), (2,)], "k int"), found, "k")
    assert rows(hit, "k", "r") == [(1, "x")] and rows(miss, "k") == [(2,)]


def test_updates_take_the_last_change(spark):
    table = spark.createDataFrame([("A", "x"), ("b", None)], "k string, v string")
    changes = spark.createDataFrame([("a", "one", 1), ("A", "two", 2), ("a", "three", 2)], "k string, v string, at int")
    assert rows(upsert.update_by_key(table, changes, "k", "v", "at", fold_case=True), "k", F.coalesce("v", F.lit("-"))) == [("A", "two"), ("b", "-")]


@pytest.mark.parametrize("name", ["bm25_topk", "citation_windows", "upsert_last_wins", "html_sections"])
def test_registered_queries_run(spark, name):
    from tessera import queries

    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0


@pytest.mark.parametrize("most", [10_000, 0])
def test_dictionaries_of_any_size(spark, most):
    rnd = random.Random(6)
    names = ["".join(rnd.choice("abcñ日 ") for _ in range(rnd.randrange(0, 14))) for _ in range(80)] + [None, "", "abc"]
    keys = ["".join(rnd.choice("abcñ日 ") for _ in range(rnd.randrange(1, 7))) for _ in range(60)] + [None]
    left = spark.createDataFrame([(i, n) for i, n in enumerate([*names, names[0]])], "i long, name string")
    right = spark.createDataFrame([(k, n % 7 if n % 5 else None, n) for n, k in enumerate(keys)], "k string, o int, v int")
    first = {}
    for n, k in sorted(enumerate(keys), key=lambda x: (x[0] % 7 if x[0] % 5 else 0, x[1] or "")):
        if k is not None:
            first.setdefault(k, (n % 7 if n % 5 else 0, k))
    got = {r["i"]: r["k"] for r in match.dictionary_join(left, F.col("name"), right, "k", "o", most_rows=most).collect()}
    for i, name in enumerate([*names, names[0]]):
        fits = [order for k, order in first.items() if name is not None and k in name]
        assert got[i] == (min(fits)[1] if fits else None), name
    assert len(got) == left.count()
