"""Table-valued extraction from texts and HTML, as arrays of structs that are exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clave_parts, decode_entities, drop_blocks, first_match, ordered_case, rx, squeeze, strip, text_only
from . import catalog


def dedup_citations(cites: DataFrame, key: list[str], order: list[str], compat: bool = False) -> DataFrame:
    """The first row of each key. With ``compat``, as an insert that ignores conflicts does: a key with a null part
    never conflicts, so all its rows stay."""
    first = cites.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    keep = (F.col("_n") == 1) if not compat else ((F.col("_n") == 1) | ~whole)
    return first.where(keep).drop("_n")


def case_keys(df: DataFrame, id_col: str, text_col: str, pattern: str = catalog.CASE_KEY) -> DataFrame:
    """Distinct (id, clave) of case keys in texts, white space squeezed."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(rx(pattern)), F.lit(1))
    return df.select(F.col(id_col).alias("id"), F.explode(F.transform(found, squeeze)).alias("clave")).distinct()


def section_class(c: Column) -> Column:
    """What a paragraph's class says it is; the first class word in it decides."""
    return ordered_case(F.lower(c), catalog.SECTION_CLASSES, "otro")


_SECTION = r"(?is)<(p|h1|h2|h3)\b([^>]*)>(.*?)(?=</?(?:p|h1|h2|h3)\b|</(?:body|article|div|footer)\b|$)"


def html_sections(df: DataFrame, id_col: str, html_col: str, most: int | None = None, least: int = 3) -> DataFrame:
    """(id, section_index, section_type, text) of paragraphs and headings in document order.

    Script and style go first. An element ends where the next of its kind opens or any closes, so unclosed paragraphs
    are whole. The class names the type, or the tag without one; texts under ``least`` characters don't count in the
    index. A page with no element at all is one ``cuerpo`` section.
    """
    clean = drop_blocks(F.col(html_col))
    tags, attrs, bodies = (F.regexp_extract_all(clean, F.lit(_SECTION), F.lit(g)) for g in (1, 2, 3))
    zipped = F.arrays_zip(tags.alias("tag"), attrs.alias("attr"), bodies.alias("body"))

    def section(x: Column) -> Column:
        name = F.regexp_extract(x["attr"], r"""(?i)class\s*=\s*["']([^"']*)["']""", 1)
        text = text_only(x["body"], entities=True)
        return F.struct(F.when(name != "", section_class(name)).otherwise(F.lower(x["tag"])).alias("type"), (F.substring(text, 1, most) if most else text).alias("text"))

    found = F.filter(F.transform(zipped, section), lambda s: F.length(s["text"]) >= least)
    whole = text_only(clean, entities=True)
    fallback = F.when(F.length(whole) >= least, F.array(F.struct(F.lit("cuerpo").alias("type"), whole.alias("text")))).otherwise(F.array().cast("array<struct<type:string,text:string>>"))
    chosen = F.when(F.size(found) > 0, found).otherwise(fallback)
    rows = df.select(F.col(id_col).alias("id"), F.posexplode(chosen).alias("section_index", "s"))
    return rows.select("id", "section_index", F.col("s.type").alias("section_type"), F.col("s.text").alias("text"))


def labelled_fields(c: Column, labels: list[str]) -> Column:
    """Map of label to value from ``<b>LABEL:</b> value`` HTML; a value runs to the next known label or the end of its
    table row, table or section. The last of a repeated label counts."""
    names = "|".join(labels)
    stop = rf"(?:<b>\s*(?:{names})\s*:|</tr>|</table>|</section>|</aside>|<hr|<footer|$)"
    pattern = rf"(?is)<b>\s*({names})\s*:\s*</b>(.*?)(?={stop})"
    keys, values = (F.regexp_extract_all(c, F.lit(pattern), F.lit(g)) for g in (1, 2))
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(F.upper(k).alias("k"), text_only(v, entities=True).alias("v")))
    last = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))
    return F.map_filter(last, lambda _, v: v != "")


def title_cascade(c: Column, tags: tuple[str, ...] = ("h4", "h3", "h2", "h1", "h5"), more_than: int = 8, stop_words: str = r"(?iu)men[uú]|inicio|buscar") -> Column:
    """The first heading, tag by tag, that is long enough and has no navigation word."""
    choices = []
    for tag in tags:
        texts = F.transform(F.regexp_extract_all(drop_blocks(c), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1)), lambda x: text_only(x, entities=True))
        choices.append(F.try_element_at(F.filter(texts, lambda t: (F.length(t) > more_than) & ~t.rlike(stop_words)), F.lit(1)))
    return F.coalesce(*choices)


def html_links(df: DataFrame, id_col: str, html_col: str, extensions: str = "") -> DataFrame:
    """(id, link_index, href, label) of links, of the given extensions ('pdf|docx?') if any."""
    end = rf"\.(?:{extensions})(?:[?#][^\"']*)?" if extensions else ""
    pattern = rf"""(?is)<a\b[^>]*href\s*=\s*["']([^"']*{end})["'][^>]*>(.*?)</a>"""
    hrefs, labels = (F.regexp_extract_all(drop_blocks(F.col(html_col)), F.lit(pattern), F.lit(g)) for g in (1, 2))
    rows = df.select(F.col(id_col).alias("id"), F.posexplode(F.arrays_zip(hrefs.alias("href"), labels.alias("label"))).alias("link_index", "l"))
    return rows.select("id", "link_index", decode_entities(F.col("l.href")).alias("href"), text_only(F.col("l.label"), entities=True).alias("label"))


def catalogue_rows(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Rows of an HTML catalogue that link a document: (id, row_index, nombre, abreviatura, fecha, urls).

    nombre is the first cell that isn't a mere label, or the longest where that has under 8 characters.
    """
    table = df.select(F.col(id_col).alias("id"), F.posexplode(F.regexp_extract_all(drop_blocks(F.col(html_col)), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_index", "tr"))
    cells = F.transform(F.regexp_extract_all("tr", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lambda x: text_only(x, entities=True))
    table = table.withColumn("cells", F.filter(cells, lambda x: x != "")).withColumn("urls", F.regexp_extract_all("tr", F.lit(r"""(?i)href\s*=\s*["']([^"']+\.(?:pdf|docx?|html?))["']"""), F.lit(1)))
    label = r"(?iu)^(pdf|word|docx?|html?|ver|descargar|\d+|\d{2}[/-]\d{2}[/-]\d{4})$"
    first = F.try_element_at(F.filter("cells", lambda x: ~x.rlike(label)), F.lit(1))
    longest = F.array_max(F.transform("cells", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    joined = F.array_join("cells", " | ")
    return table.where(F.exists("urls", lambda u: u.rlike(r"(?i)\.(pdf|docx?)$"))).select(
        "id",
        "row_index",
        F.when(F.length(first) >= 8, first).otherwise(longest).alias("nombre"),
        F.try_element_at(F.filter("cells", lambda x: x.rlike(r"^[A-ZÁÉÍÓÚÑ]{2,12}$")), F.lit(1)).alias("abreviatura"),
        first_match(joined, r"\d{2}[/-]\d{2}[/-]\d{4}").alias("fecha"),
        "urls",
    )


def numbered_recommendation(label: Column, address: Column | None = None, first_year: int = 1990, last_year: int = 2026) -> Column:
    """(number, year) of a recommendation from a link's label, or else from its address; the two are swapped where only
    the swap gives a year."""
    sources = [(label, p) for p in catalog.RECOMMENDATION_LABELS] + [(address, p) for p in catalog.RECOMMENDATION_ADDRESSES if address is not None]
    pairs = []
    for c, pattern in sources:
        a, b = (F.regexp_extract(c, rx(pattern), g).try_cast("int") for g in (1, 2))
        swap = ~b.between(first_year, last_year) & a.between(first_year, last_year)
        pairs.append(F.when(c.rlike(rx(pattern)), F.struct(F.when(swap, b).otherwise(a).alias("number"), F.when(swap, a).otherwise(b).alias("year"))))
    return F.coalesce(*pairs)


def recommendation_fields(df: DataFrame, text_col: str) -> DataFrame:
    """Number, addressee, date and subject of a recommendation from its text, added as columns."""
    t = F.col(text_col)
    return df.withColumns(
        {
            "num_rec": F.concat(F.lit("Recomendación "), first_match(t, rx(catalog.RECOMMENDATION_NUMBER), 1)),
            "destinatario": F.substring(strip(first_match(t, rx(catalog.RECOMMENDATION_ADDRESSEE), 1)), 1, 200),
            "fecha": first_match(t, rx(catalog.RECOMMENDATION_DATE), 1),
            "tema": strip(first_match(t, rx(catalog.RECOMMENDATION_SUBJECT, "idmU"), 1)),
        }
    )


def _before(t: Column, pattern: str, flags: str) -> Column:
    """How many characters of t precede a pattern's first match; null without any."""
    return F.when(t.rlike(rx(pattern, flags)), F.length(F.regexp_extract(t, rx(rf"\A((?s:.*?))(?:{pattern})", flags), 1)))


def thesis_fields(df: DataFrame, text_col: str) -> DataFrame:
    """Fields of an administrative thesis from its extracted text, added as columns.

    The body runs from the heading to the precedents' mark, or else to the first procedural line after the heading,
    which is then the first of the precedents; these end where the review is cited. Later fields are looked for in the
    precedents where there are any.
    """
    t = F.col(text_col)
    cased, caseless = "mdU", "idU"
    after = F.regexp_extract(t, rx(catalog.THESIS_RUBRO + r"((?s:.*))\z", "msdU"), 2)  # what follows the heading
    has_rubro = t.rlike(rx(catalog.THESIS_RUBRO, "msdU"))
    begin = F.when(has_rubro, F.length(t) - F.length(after)).otherwise(0)
    mark = _before(t, catalog.THESIS_PRECEDENTS, caseless)
    marked_end = F.length(F.regexp_extract(t, rx(rf"\A((?s:.*?)(?:{catalog.THESIS_PRECEDENTS}))", caseless), 1))
    procedure = begin + _before(F.when(has_rubro, after).otherwise(t), catalog.THESIS_PROCEDURE, "idmU")
    body_end = F.coalesce(mark, procedure)
    tail = F.substring(t, F.when(mark.isNotNull(), marked_end).otherwise(procedure) + 1, F.length(t))
    cited = _before(tail, catalog.THESIS_REVISTA, caseless)
    precedent = F.nullif(strip(F.when(cited.isNotNull(), F.substring(tail, F.lit(1), cited)).otherwise(tail)), F.lit(""))
    rest = F.coalesce(precedent, t)
    clave = strip(first_match(t, rx(catalog.THESIS_CLAVE, cased), 1))
    revista = strip(first_match(t, rx(catalog.THESIS_REVISTA)))
    epoca, sala = clave_parts(clave)
    return df.withColumns(
        {
            "clave": clave,
            "epoca": epoca,
            "sala": sala,
            "materia": squeeze(first_match(t, rx(catalog.THESIS_MATERIA, "msdU"), 1)),
            "rubro": squeeze(first_match(t, rx(catalog.THESIS_RUBRO, "msdU"), 1)),
            "texto": F.when(has_rubro, F.nullif(strip(F.substring(t, begin + 1, F.greatest(F.lit(0), body_end - begin))), F.lit(""))),
            "precedente": precedent,
            "juicio": strip(first_match(rest, rx(catalog.THESIS_JUICIO), 1)),
            "ponente": strip(first_match(rest, rx(catalog.THESIS_PONENTE), 1)),
            "secretario": strip(first_match(rest, rx(catalog.THESIS_SECRETARIO), 1)),
            "votacion": strip(first_match(rest, rx(catalog.THESIS_VOTACION), 1)),
            "fecha": strip(first_match(rest, rx(catalog.THESIS_SESION), 1)),
            "revista": revista,
            "anio": F.regexp_extract(revista, rx(catalog.THESIS_REVISTA_ANIO), 1).try_cast("int"),
        }
    )


def court_fields(df: DataFrame, text_col: str, compat: bool = False) -> DataFrame:
    """Name, kind, country, date and year of an international court's document, from the text of its first pages.

    The date is the judgment's own. With ``compat`` a country's name ends at its first word.
    """
    t = F.col(text_col)
    country = r"(?i:\bVs\.)\s+(\w+)" if compat else r"(?i:\bVs\.)\s+([A-ZÁÉÍÓÚÑ]\w+(?:\s+(?:de\s+|la\s+|y\s+)*[A-ZÁÉÍÓÚÑ]\w+)*)"
    date = first_match(t, rx(catalog.COURT_DATE), 1)
    return df.withColumns(
        {
            "nombre": squeeze(F.coalesce(*[first_match(t, rx(p, "idmU"), 1) for p in (catalog.COURT_CASE, catalog.COURT_OPINION)])),
            "tipo": F.when(t.contains("Opinión Consultiva") | t.contains("OPINIÓN CONSULTIVA"), "opinion_consultiva").when(t.contains("Caso"), "sentencia_contenciosa"),
            "pais": first_match(t, "(?dU)" + country, 1),
            "fecha": date,
            "anio": F.regexp_extract(date, r"\b((?:19|20)\d{2})\b", 1).try_cast("int"),
        }
    )


def gazette_fields(df: DataFrame, html_col: str, most: int = 200_000) -> DataFrame:
    """Title, issuing ministry, kind and text of a gazette note; a kind stands at the very start of the squeezed text."""
    text = text_only(F.col(html_col), entities=True)
    return df.withColumns(
        {
            "titulo": strip(first_match(F.col(html_col), rx(catalog.GAZETTE_TITLE), 1)),
            "organismo": strip(first_match(F.col(html_col), rx(catalog.GAZETTE_ISSUER), 1)),
            "tipo": F.substring(strip(first_match(text, rx(catalog.GAZETTE_KIND), 1)), 1, 120),
            "texto": F.substring(text, 1, most),
        }
    )


def electoral_fields(df: DataFrame, html_col: str) -> DataFrame:
    """Fields of an electoral court's thesis page; its text is the longest paragraph."""
    t = text_only(F.replace(F.col(html_col), F.lit("&nbsp;"), F.lit(" ")))
    kind = F.lower(first_match(t, rx(catalog.ELECTORAL_TIPO), 1))
    return df.withColumns(
        {
            "rubro": strip(first_match(t, rx(catalog.ELECTORAL_RUBRO), 1)),
            "clave": squeeze(first_match(t, rx(catalog.ELECTORAL_CLAVE), 1)),
            "instancia": strip(first_match(t, rx(catalog.ELECTORAL_INSTANCIA), 1)),
            "tipo": F.when(kind.contains("jurisprudencia"), "jurisprudencia").when(kind.isNotNull(), "tesis_aislada"),
            "partes": strip(first_match(t, rx(catalog.ELECTORAL_PARTES), 1)),
            "fecha": first_match(t, rx(catalog.ELECTORAL_FECHA), 1),
            "anio": F.regexp_extract(t, rx(catalog.ELECTORAL_FECHA), 2).try_cast("int"),
            "texto": longest_paragraph(F.col(html_col)),
        }
    )


def country_entry(c: Column, country: str, most: int = 6000, heading: str = "") -> Column:
    """A country's entry on a treaty page, from its name to the next heading; only after ``heading`` where given."""
    start = rf"(?:{heading}).*?" if heading else ""
    found = first_match(c, rf"(?is){start}(<[^>]+>\s*{country}\s*<.{{100,{most}}}?)(?=<(?:b|strong|h\d)\b|\z)", 1)
    return F.substring(text_only(found, entities=True), 1, most)


def longest_paragraph(c: Column, more_than: int = 80, under: int = 4000) -> Column:
    texts = F.transform(F.regexp_extract_all(drop_blocks(c), F.lit(r"(?is)<p\b[^>]*>(.*?)(?=</?p\b|$)"), F.lit(1)), lambda x: text_only(x, entities=True))
    fit = F.filter(texts, lambda t: (F.length(t) > more_than) & (F.length(t) < under))
    return F.array_max(F.transform(fit, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]


def precedent_bridge(df: DataFrame, id_col: str, notes_col: str) -> DataFrame:
    """(id, orden, asunto, expediente) over an array of HTML notes: every tagged pair, one order across the notes; a note
    without pairs keeps one row of nulls."""
    asunto, expediente = (rf"""(?is)data-{name}\s*=\s*["']([^"']*)["']""" for name in ("asunto", "expediente"))

    def pairs(note: Column) -> Column:
        found = F.arrays_zip(F.regexp_extract_all(note, F.lit(asunto), F.lit(1)).alias("asunto"), F.regexp_extract_all(note, F.lit(expediente), F.lit(1)).alias("expediente"))
        none = F.array(F.struct(F.lit(None).cast("string").alias("asunto"), F.lit(None).cast("string").alias("expediente")))
        return F.when(F.size(found) > 0, found).otherwise(none)

    rows = df.select(F.col(id_col).alias("id"), F.posexplode(F.flatten(F.transform(notes_col, pairs))).alias("orden", "p"))
    return rows.select("id", "orden", F.nullif("p.asunto", F.lit("")).alias("asunto"), F.nullif("p.expediente", F.lit("")).alias("expediente"))


def array_bridge(df: DataFrame, id_col: str, array_col: str, value: str = "value") -> DataFrame:
    """Distinct (id, value) of an array's values that are neither null nor empty."""
    rows = df.select(F.col(id_col).alias("id"), F.explode(array_col).alias(value))
    return rows.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).distinct()


def embedded_codes(c: Column, pattern: str = r"codigo=(\d+)", above: int = 1_000_000, below: int = 10_000_000) -> Column:
    """Distinct numbers in a page between two bounds, both exclusive, ascending."""
    codes = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda x: x.try_cast("long"))
    return F.array_sort(F.array_distinct(F.filter(codes, lambda x: (x > above) & (x < below))))


def status_lines(df: DataFrame, doc_col: str, line_col: str, order_col: str, headings: list[tuple[str, str]] = catalog.STATUS_HEADINGS, key: str = catalog.STATUS_KEY, severity: dict[str, int] = catalog.STATUS_SEVERITY) -> DataFrame:
    """(doc, clave, status): every key in a list with the heading it stands under, the most severe where there are several.

    Keys before any heading have no status and go. Pass the short key pattern for the form that ends at a hyphen.
    """
    upper, status = F.upper(F.col(line_col)), None
    for pattern, value in headings:
        status = F.when(upper.rlike(pattern), value) if status is None else status.when(upper.rlike(pattern), value)
    carried = F.last(status, ignorenulls=True).over(Window.partitionBy(doc_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("_status", carried).where("_status is not null")
    keys = rows.select(doc_col, "_status", F.explode(F.regexp_extract_all(F.upper(F.col(line_col)), F.lit(key), F.lit(1))).alias("clave"))
    rank = F.create_map(*[F.lit(x) for pair in severity.items() for x in pair])
    return keys.groupBy(doc_col, "clave").agg(F.max_by("_status", F.coalesce(rank[F.col("_status")], F.lit(0))).alias("status"))
