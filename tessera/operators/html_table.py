"""HTML pages as a table of elements, made in one pass, from which selectors, contents and tags are picked."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import drop_blocks, rx, text_only
from . import catalog
from .batches import small_batches

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?=[\s/>])([^>]*)>")
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FIELDS = (("element", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("id", pa.string()), ("classes", pa.list_(pa.string())), ("href", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("closed", pa.bool_()))
ELEMENTS = "array<struct<element:int,parent:int,depth:int,tag:string,id:string,classes:array<string>,href:string,begin:int,end:int,closed:boolean>>"


def parse_elements(html: str) -> list[tuple]:
    """A page's elements in the order of their opening tags, as tuples of the fields of ELEMENTS.

    begin and end are the places of what is inside. An element ends at the closing tag that counting its own kind off
    gives, whatever is unclosed in between, or at the page's end. The parent is the innermost element that is open.
    """
    rows: list[list] = []
    of_kind: dict[str, list[int]] = {}
    open_: dict[int, None] = {}
    for m in _TAG.finditer(html):
        tag = m[2].lower()
        if m[1]:
            if own := of_kind.get(tag):
                row = rows[own.pop()]
                row[8], row[9] = m.start(), True
                del open_[row[0]]
            continue
        found = {}
        for a in _ATTRIBUTE.finditer(m[3]):
            found.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
        parent = next(reversed(open_), None)
        depth = 0 if parent is None else rows[parent][2] + 1
        n = len(rows)
        rows.append([n, parent, depth, tag, found.get("id"), (found.get("class") or "").split(), found.get("href"), m.end(), len(html), False])
        if tag in _VOID:
            rows[n][8] = m.end()
        else:
            of_kind.setdefault(tag, []).append(n)
            open_[n] = None
    return rows


def with_elements(df: DataFrame, html_col: str, into: str = "elements") -> DataFrame:
    """df with the elements of a page as an array (see parse_elements); none for null and empty pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            pages = [parse_elements(h) if h else [] for h in batch.column(html_col).to_pylist()]
            columns = list(zip(*(row for page in pages for row in page), strict=True)) or [()] * len(_FIELDS)
            flat = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])
            ends = [0]
            for page in pages:
                ends.append(ends[-1] + len(page))
            yield batch.append_column(into, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))

    schema = T.StructType([*df.schema.fields, T.StructField(into, T._parse_datatype_string(ELEMENTS))])
    return df.mapInArrow(run, schema)


def html_elements(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(page, element, parent, depth, tag, id, classes, href, begin, end, closed): one row an element."""
    pages = with_elements(df.select(F.col(id_col).alias("page"), F.col(html_col).alias("html")), "html")
    return pages.select("page", F.explode("elements").alias("e")).select("page", "e.*")


def selected(elements: Column, selector: str) -> Column:
    """The elements that a selector (``tag``, ``#id``, ``tag#id`` or ``tag.class``) names."""
    sign = "#" if "#" in selector else "."
    tag, _, name = selector.partition(sign)

    def fits(e: Column) -> Column:
        out = e["tag"] == tag.lower() if tag else F.lit(True)
        if name:
            out = out & (F.coalesce(e["id"] == name, F.lit(False)) if sign == "#" else F.array_contains(e["classes"], name))
        return out

    return F.filter(elements, fits)


def inside(html: Column, element: Column) -> Column:
    return F.substring(html, element["begin"] + 1, element["end"] - element["begin"])


def main_contents(df: DataFrame, html_col: str, into: str = "text", selectors: tuple[str, ...] = catalog.GAZETTE_SELECTORS, least: int = 200, chrome: str = catalog.GAZETTE_CHROME, beginning: str = catalog.GAZETTE_BEGINNING, most: int | None = None, closed: bool = False) -> DataFrame:
    """df with each page's main text: of the first selector's first element that has more than ``least`` characters and no
    page chrome at its head, or else of the body from the first word that real contents begin with. With ``closed`` only elements that have a closing tag count, and a page without such a body has an empty text. Texts are whole, or of ``most`` characters.

    Each page is gone over once; the choices are cut out of it and stripped of their tags once each.
    """
    pages = with_elements(df.withColumn("_clean", drop_blocks(F.col(html_col), *catalog.GAZETTE_DROPPED)), "_clean", "_elements")
    clean = F.col("_clean")
    elements = F.filter("_elements", lambda e: e["closed"]) if closed else F.col("_elements")
    firsts = F.array_compact(F.array(*[F.try_element_at(selected(elements, s), F.lit(1)) for s in selectors]))
    texts = F.transform(firsts, lambda e: text_only(inside(clean, e), entities=True))
    fit = F.try_element_at(F.filter(texts, lambda t: (F.length(t) > least) & ~F.substring(t, 1, 200).rlike(rx(chrome))), F.lit(1))
    body = F.try_element_at(selected(elements, "body"), F.lit(1))
    without = F.when(clean.isNotNull(), F.lit("")) if closed else clean
    chosen = pages.withColumn("_fit", fit).withColumn("_body", F.when(fit.isNull(), text_only(F.coalesce(inside(clean, body), without), entities=True)))
    found = F.nullif(F.regexp_extract("_body", rf"(?sU)({beginning}.*)\z", 1), F.lit(""))
    text = F.coalesce("_fit", found, "_body")
    return chosen.withColumn(into, F.substring(text, 1, most) if most else text).drop("_clean", "_elements", "_fit", "_body")
