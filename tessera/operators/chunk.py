"""Cutting texts to chunks: (id, chunk_index, chunk_type, text, char_count)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

BLANK_LINE = r"\n\s*\n"
# Fixed value: where a law's articles begin.
ARTICLE_START = r"(?U)\bArt[íi]culo\s+(\d+(?:\s*Bis(?:\s*\d+)?)?)\."


def paragraphs(c: Column, separator: str = BLANK_LINE, more_than: int = 80, most: int | None = None, cap_first: bool = False, cut: int | None = None) -> Column:
    """Stripped paragraphs longer than ``more_than``, ``most`` of them. cap_first takes the first ``most`` and then drops
    short ones; otherwise short ones don't count."""
    texts = F.transform(F.split(c, "(?U)" + separator, -1), strip)
    if cap_first and most:
        texts = F.slice(texts, 1, most)
    kept = F.filter(texts, lambda t: F.length(t) > more_than)
    if most and not cap_first:
        kept = F.slice(kept, 1, most)
    return F.transform(kept, lambda t: F.substring(t, 1, cut)) if cut else kept


def marked_sections(c: Column, marker: str = ARTICLE_START, more_than: int = 30, cut: int | None = None, whole: int | None = None) -> Column:
    """(type, text) of a text cut at numbered markers. What comes before the first marker is dropped, and bodies of
    ``more_than`` characters or fewer are; a text without markers is one piece. Bodies and texts are whole, or of
    ``cut`` and of ``whole`` characters."""

    def first(t: Column, most: int | None) -> Column:
        return F.substring(t, 1, most) if most else t

    numbers = F.regexp_extract_all(c, F.lit(marker), F.lit(1))
    bodies = F.slice(F.split(c, marker, -1), 2, F.greatest(F.size(numbers), F.lit(1)))
    parts = F.zip_with(numbers, bodies, lambda n, b: F.struct(strip(n).alias("n"), strip(b).alias("b")))
    kept = F.filter(parts, lambda p: F.length(p["b"]) > more_than)
    articles = F.transform(kept, lambda p: F.struct(F.lit("articulo").alias("type"), F.concat(F.lit("Artículo "), p["n"], F.lit(". "), first(p["b"], cut)).alias("text")))
    body = F.array(F.struct(F.lit("cuerpo").alias("type"), strip(first(c, whole)).alias("text")))
    return F.when(F.size(numbers) > 0, articles).otherwise(body)


def piece(kind: str, c: Column) -> Column:
    """An array of one chunk, or none for null and empty text."""
    return F.when(c.isNotNull() & (c != ""), F.array(F.struct(F.lit(kind).alias("type"), c.alias("text")))).otherwise(F.array().cast("array<struct<type:string,text:string>>"))


def pieces(kind: str, texts: Column) -> Column:
    return F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda t: F.struct(F.lit(kind).alias("type"), t.alias("text")))


def explode_chunks(df: DataFrame, id_col: str, chunks_col: str, keep_gaps: bool = True, trim: bool = True) -> DataFrame:
    """One row per chunk. Blank chunks go; with ``keep_gaps`` they still count in chunk_index. Without ``trim`` texts stay
    as they were cut, white space at a cut included."""
    stripped = F.transform(chunks_col, lambda x: F.struct(F.coalesce(x["type"], F.lit("parrafo")).alias("type"), (strip(x["text"]) if trim else x["text"]).alias("text")))
    solid = stripped if keep_gaps else F.filter(stripped, lambda x: F.length(x["text"]) > 0)
    rows = df.select(F.col(id_col).alias(id_col), F.posexplode(solid).alias("chunk_index", "c")).where(F.length("c.text") > 0)
    return rows.select(id_col, "chunk_index", F.col("c.type").alias("chunk_type"), F.col("c.text").alias("text"), F.length("c.text").alias("char_count"))
