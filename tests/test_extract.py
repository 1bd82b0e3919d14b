import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import catalog, citations, extract, html_table


@pytest.fixture
def frame(spark):
    return lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")


@pytest.mark.parametrize(
    ("text", "groups"),
    [
        ("artículo 123, fracción IV, inciso a", ("123", "IV", "a")),
        ("artículo 8.4 de la Convención", ("8", None, None)),
        ("artículos 1 y 2", None),
        ("ARTÍCULO 14 Bis 2", ("14 Bis 2", None, None)),
    ],
)
def test_article_grammar(frame, text, groups):
    rows = citations.citation_windows(frame(text + " Ley de Amparo"), "id", "t", {"LA": catalog.LAWS["LA"]}).collect()
    assert [(r["articulo"], r["fraccion"], r["parrafo"]) for r in rows] == ([groups] if groups else [])


def test_windows_equal_python(frame):
    """Random texts: the same rows as Python's own finditer gives."""
    rnd = random.Random(3)
    words = ["Ley de Amparo", "ley  de amparo", "artículo 4", "art. 12, fracción II", "artículo 9 Bis, párrafo tercero", "que", "así", "\n", "niño", "x" * 50]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) for _ in range(80)]
    law, ref = re.compile(catalog.LAWS["LA"], re.I), re.compile(catalog.ARTICLE, re.I)
    expected = []
    for i, t in enumerate(texts):
        for m in law.finditer(t):
            w = t[max(0, m.start() - 200) : m.end() + 200]
            expected += [(i, m.start(), a.group(1), a.group(2), a.group(3), w[max(0, a.start() - 30) : a.end() + 30][:300]) for a in ref.finditer(w)]
    rows = citations.citation_windows(frame(*texts), "id", "t", {"LA": catalog.LAWS["LA"]}).collect()
    assert sorted(map(str, expected)) == sorted(str((r["id"], r["law_pos"], r["articulo"], r["fraccion"], r["parrafo"], r["raw"])) for r in rows)


def test_null_keys_dedup(spark):
    rows = spark.createDataFrame([(1, "a", None, 0), (1, "a", None, 1), (1, "a", "x", 2), (1, "a", "x", 3)], "id long, code string, parrafo string, pos int")
    key = ["id", "code", "parrafo"]
    assert extract.dedup_citations(rows, key, ["pos"]).count() == 2
    assert extract.dedup_citations(rows, key, ["pos"], compat=True).count() == 3


def test_case_keys(frame):
    got = extract.case_keys(frame("ver 2a./J. 19/2021 (11a.) y P./J. 57/2014 (10a.), I.6o.P.88 P (10a.)", "I.6o.P.88 P", "2a./J.  19/2021 (11a.)"), "id", "t").collect()
    assert sorted((r["id"], r["clave"]) for r in got) == [(0, "2a./J. 19/2021 (11a.)"), (0, "I.6o.P.88 P (10a.)"), (0, "P./J. 57/2014 (10a.)"), (2, "2a./J. 19/2021 (11a.)")]


def test_sections(frame):
    html = '<script>var t="</p>";</script><p class="corte1 datos">uno uno</p><p class="corte2 ponente">dos<br>dos<p class="foo">tres</p><h2>cuatro</h2><p>x</p>'
    got = extract.html_sections(frame(html, "<div>solo texto</div>", ""), "id", "t").collect()
    assert [(r["id"], r["section_index"], r["section_type"], r["text"]) for r in got] == [
        (0, 0, "encabezado", "uno uno"),
        (0, 1, "ponente", "dos dos"),
        (0, 2, "otro", "tres"),
        (0, 3, "h2", "cuatro"),
        (1, 0, "cuerpo", "solo texto"),
    ]


@pytest.mark.parametrize(("name", "kind"), [("corte1 datos", "encabezado"), ("corte2 ponente", "ponente"), ("corte9", "cuerpo"), ("foo", "otro")])
def test_section_classes(frame, name, kind):
    assert frame(name).select(extract.section_class(F.col("t"))).first()[0] == kind


def test_labelled_fields(frame):
    html = "<tr><td><b>TEMA:</b> agua &amp; luz</td></tr><tr><b>Estatus:</b> vigente <b>OTRO:</b> nada</tr><b>TEMA:</b> final<hr>"
    assert frame(html).select(extract.labelled_fields(F.col("t"), ["TEMA", "ESTATUS"])).first()[0] == {"TEMA": "final", "ESTATUS": "vigente OTRO: nada"}


def test_links_titles_paragraphs(frame):
    html = '<h4>corto</h4><h3>Menú de inicio del sitio</h3><h2>Tratado de Aguas</h2><a href="a.pdf?x=1">Uno</a><a href="b.html">Dos</a><p>' + "a" * 90 + "</p><p>" + "b" * 100 + "</p>"
    f = frame(html)
    assert f.select(extract.title_cascade(F.col("t"))).first()[0] == "Tratado de Aguas"
    assert [(r["href"], r["label"]) for r in extract.html_links(f, "id", "t", "pdf|docx?").collect()] == [("a.pdf?x=1", "Uno")]
    assert f.select(extract.longest_paragraph(F.col("t"))).first()[0] == "b" * 100


def test_catalogue(frame):
    html = '<table><tr><td>1</td><td>Ley de Aguas Nacionales</td><td>LAN</td><td>06/01/2020</td><td><a href="x.pdf">PDF</a></td></tr><tr><td>sin enlace</td></tr></table>'
    r = extract.catalogue_rows(frame(html), "id", "t").collect()
    assert [(x["nombre"], x["abreviatura"], x["fecha"], x["urls"]) for x in r] == [("Ley de Aguas Nacionales", "LAN", "06/01/2020", ["x.pdf"])]


def test_thesis_fields(frame):
    """Without a mark of precedents the body ends at the first procedural line, which begins them; nothing is made up."""
    text = "Materia: Fiscal\nClave: V-TASS-100\nRubro: UNO DOS\nTRES.- CUATRO\n(continúa) el cuerpo del criterio.\nRevisión No. 12/2001. Magistrada Ponente: Eva Gil. Fin.\nRTFF. Quinta Época. Año II. Mayo 2003"
    r, bare = extract.thesis_fields(frame(text, "nada de esto"), "t").collect()
    assert (r["clave"], r["epoca"], r["sala"], r["materia"], r["rubro"]) == ("V-TASS-100", "V", "100", "Fiscal", "UNO DOS TRES.- CUATRO")
    assert (r["texto"], r["precedente"]) == ("(continúa) el cuerpo del criterio.", "Revisión No. 12/2001. Magistrada Ponente: Eva Gil. Fin.")
    assert (r["juicio"], r["ponente"], r["secretario"], r["anio"], r["revista"]) == ("12/2001.", None, None, 2003, "RTFF. Quinta Época. Año II. Mayo 2003")
    assert {bare[c] for c in ("clave", "materia", "rubro", "texto", "precedente", "juicio", "ponente", "votacion", "fecha", "revista", "anio")} == {None}


def test_court_and_gazette(frame):
    f = frame("Caso X Vs. Costa Rica. Dado el 1 de enero de 1990. Sentencia de 12 de mayo de 2020", "CASO X vs. Perú, 3 de mayo de 2001")
    one, two = extract.court_fields(f, "t").collect()
    assert (one["pais"], one["anio"], one["fecha"], one["tipo"]) == ("Costa Rica", 2020, "12 de mayo de 2020", "sentencia_contenciosa")
    assert (two["pais"], two["anio"], two["tipo"]) == ("Perú", None, None)
    assert extract.court_fields(f, "t", compat=True).first()["pais"] == "Costa"
    assert extract.gazette_fields(frame("<p>Texto sin nada. ACUERDO</p>"), "t").first()["tipo"] is None
    assert extract.gazette_fields(frame("<p>ACUERDO por el que se reforma. Y más</p>"), "t").first()["tipo"] == "ACUERDO por el que se reforma"


def test_elements_end_at_their_own_tag(frame):
    html = '<div id="a">uno<div>dos</div>tres</div>cuatro<DIV class="x content y">cinco<div class="content-no">seis</div></div><main>siete'
    pages = html_table.with_elements(frame(html), "t")
    firsts = [F.try_element_at(html_table.selected(F.col("elements"), s), F.lit(1)) for s in ("#a", "div#a", "div.content", "main", "article", "div.y", "div.content-n")]
    got = pages.select(*[html_table.inside(F.col("t"), e).alias(str(i)) for i, e in enumerate(firsts)]).first()
    assert [g and " ".join(re.sub("<[^>]+>", " ", g).split()) for g in got] == ["uno dos tres", "uno dos tres", "cinco seis", "siete", None, "cinco seis", None]


def test_element_table(spark):
    html = "<html><BODY class='a  b'><p id=x>uno<p>dos</div></p><img src=1><a href='u?v=1&w' >t<br/></a></html>"
    df = spark.createDataFrame([(1, html), (1, html), (None, "<p>z"), (2, None), (3, ""), (4, "<" * 100_000), (5, "sin nada")], "id long, html string").withColumn("tag", F.lit("clash"))
    rows = [r for r in html_table.html_elements(df, "id", "html").collect() if r["page"] == 1]
    assert len(rows) == 14
    got = {r["element"]: r for r in rows}
    assert [got[i]["tag"] for i in range(7)] == ["html", "body", "p", "p", "img", "a", "br"]
    assert [got[i]["parent"] for i in range(7)] == [None, 0, 1, 2, 2, 2, 5] and [got[i]["depth"] for i in range(7)] == [0, 1, 2, 3, 3, 3, 4]
    assert [got[i]["closed"] for i in range(7)] == [True, False, False, True, False, True, False]
    assert got[1]["classes"] == ["a", "b"] and got[2]["id"] == "x" and got[5]["href"] == "u?v=1&w"
    assert html[got[3]["begin"] : got[3]["end"]] == "dos</div>" and html[got[5]["begin"] : got[5]["end"]] == "t<br/>"
    assert html_table.html_elements(df.limit(0), "id", "html").count() == 0
    assert sorted(str(r["text"]) for r in html_table.main_contents(df, "html").where("id is null or id > 1").collect()) == ["", "<" * 100_000, "None", "sin nada", "z"]


def test_main_contents_of_closed_elements(spark):
    """A page that breaks off has no closed body, so nothing of it counts where closed elements are asked for."""
    article = "<article>" + "a" * 300
    pages = [(1, f"<body>x{article}</article></body>"), (2, f"<body>x{article}</body>"), (3, f"<body>x{article}</article>"), (4, "<body>corta"), (5, None), (6, "nada")]
    df = spark.createDataFrame(pages, "id long, html string")
    texts = {c: [r["text"] for r in html_table.main_contents(df, "html", closed=c).orderBy("id").collect()] for c in (True, False)}
    assert texts[True] == ["a" * 300, "x " + "a" * 300, "a" * 300, "", None, ""]
    assert texts[False] == ["a" * 300] * 3 + ["corta", None, "nada"]


def test_main_contents_are_whole(spark):
    """Texts of more than 300,000 characters, by an element, by a beginning and by the body."""
    long = "palabra " * 50_000 + "fin"
    pages = [(1, f"<body>x<article>{long}</article></body>"), (2, f"<body>x DECRETO {long}</body>"), (3, f"<body>{long}</body>")]
    df = spark.createDataFrame(pages, "id long, html string")
    for closed in (True, False):
        texts = [r["text"] for r in html_table.main_contents(df, "html", closed=closed).orderBy("id").collect()]
        assert texts == [long, f"DECRETO {long}", long]


def test_country_entry(frame):
    html = "<h2>Reservas</h2><b>Francia</b><p>" + "f" * 120 + "</p><b> México </b><p>" + "m" * 120 + "</p><b>Noruega</b><p>no</p>"
    assert frame(html).select(extract.country_entry(F.col("t"), "México")).first()[0] == "México " + "m" * 120


def test_recommendation_flip(frame):
    rows = frame("Recomendación 12/2020", "2019/0015", "2019/15", "nada").select(extract.numbered_recommendation(F.col("t")).alias("r")).collect()
    assert [r["r"] and (r["r"]["number"], r["r"]["year"]) for r in rows] == [(12, 2020), (15, 2019), None, None]


def test_codes(frame):
    assert frame("?codigo=5000001&codigo=5000001 codigo=12 codigo=1000000").select(extract.embedded_codes(F.col("t"))).first()[0] == [5000001]


def test_precedents_and_bridges(spark):
    df = spark.createDataFrame([(1, ['<a data-asunto="A" data-expediente="1/2"></a><a data-asunto="B" data-expediente="3/4"></a>', "solo texto"])], "id long, notes array<string>")
    got = extract.precedent_bridge(df, "id", "notes").collect()
    assert [(r["orden"], r["asunto"], r["expediente"]) for r in got] == [(0, "A", "1/2"), (1, "B", "3/4"), (2, None, None)]
    arr = spark.createDataFrame([(1, ["a", "", None, "a"])], "id long, m array<string>")
    assert [tuple(r) for r in extract.array_bridge(arr, "id", "m").collect()] == [(1, "a")]


def test_status_lines(spark):
    lines = ["VIII-P-1aS-1", "JURISPRUDENCIAS MODIFICADAS", "VIII-P-1aS-660 y V-TASS-100", "DEROGADAS", "V-TASS-100"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc long, n int, line string")
    got = {r["clave"]: r["status"] for r in extract.status_lines(df, "doc", "line", "n").collect()}
    assert got == {"VIII-P-1AS-660": "modificada", "V-TASS-100": "derogada"}
    short = {r["clave"] for r in extract.status_lines(df, "doc", "line", "n", key=catalog.STATUS_KEY_SHORT).collect()}
    assert short == {"VIII-P-1AS", "V-TASS-100"}
