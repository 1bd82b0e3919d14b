"""Citations: found in one scan of whole texts, and resolved to the documents that they name."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze
from . import catalog
from .batches import small_batches

#: A pattern's literal beginning has at least so many characters, and at most so many forms.
LEAST_HEAD, MOST_HEADS = 3, 64


def _folded(text: str) -> str:
    """Lower case, one character for one, with the letters that caseless patterns take for i and s."""
    return text.replace("İ", "i").lower().replace("ſ", "s").replace("ı", "i")


def _alternatives(pattern: str) -> list[str]:
    out, depth, start, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 2)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*out, pattern[start:]]


def literal_heads(pattern: str) -> list[str] | None:
    """The folded texts that every match of a pattern begins with one of; None where they are too short or too many."""
    heads = set()
    for alternative in _alternatives(pattern):
        texts, rest = [""], alternative
        while rest:
            found = re.match(r"\[([^\]\\^-]+)\]|([^\\.^$*+?{}\[\]()|])", rest)
            if not found or rest[found.end() : found.end() + 1] in ("?", "*", "{"):
                break
            texts, rest = [t + c for t in texts for c in found[1] or found[2]], rest[found.end() :]
            if rest[:1] == "+":
                break
        heads |= {_folded(t) for t in texts}
    return sorted(heads) if all(len(h) >= LEAST_HEAD for h in heads) and len(heads) <= MOST_HEADS else None


class PatternScan:
    """All matches of many patterns in a text, each pattern's as ``finditer`` gives them.

    One automaton of the patterns' literal beginnings goes over the text once; a pattern is tried only where its
    beginning stands. Patterns without one are searched on their own.
    """

    def __init__(self, patterns: list[str], caseless: bool = True):
        self.compiled = [re.compile(p, re.I if caseless else 0) for p in patterns]
        self.loose, users = [], {}
        for i, p in enumerate(patterns):
            heads = literal_heads(p)
            if heads is None:
                self.loose.append(i)
            for h in heads or ():
                users.setdefault(h, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for h, own in users.items():
            self.automaton.add_word(h, (len(h), own))
        if users:
            self.automaton.make_automaton()
        self.heads = bool(users)

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(pattern, start, end), pattern after pattern."""
        places: dict[int, list[int]] = {}
        if self.heads:
            for last, (size, own) in self.automaton.iter(_folded(text)):
                for i in own:
                    places.setdefault(i, []).append(last - size + 1)
        found = [(i, m.start(), m.end()) for i in self.loose for m in self.compiled[i].finditer(text)]
        for i, starts in places.items():
            free = 0
            for start in sorted(starts):
                if start >= free and (m := self.compiled[i].match(text, start)):
                    found.append((i, start, m.end()))
                    free = m.end()
        return sorted(found)


def citation_windows(df: DataFrame, id_col: str, text_col: str, patterns: dict[str, str], article: str = catalog.ARTICLE, reach: int = 200, around: int = 30, most: int = 300, caseless: bool = True) -> DataFrame:
    """Article references near laws: (id, code, law_ord, law_pos, ref_pos, articulo, fraccion, parrafo, raw).

    Each match of a law's pattern opens a window of ``reach`` characters either side; every reference in it is a row,
    so a reference near two laws is one for each. ``raw`` is the reference with ``around`` characters either side,
    at most ``most``. Whole texts are gone over once, whatever the number of patterns; the work beyond that is in
    the matches. Null and empty texts have none.
    """
    codes, sources = list(patterns), list(patterns.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, ref = PatternScan(sources, caseless), re.compile(article, re.I if caseless else 0)
        for batch in small_batches(batches):
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for law, start, end in scan.matches(text) if text else ():
                    window = text[max(start - reach, 0) : end + reach]
                    for k, m in enumerate(ref.finditer(window)):
                        raw = window[max(m.start() - around, 0) : m.end() + around][:most]
                        rows.append((i, codes[law], law, start, k, m[1] or "", m[2] or None, m[3] or None, raw))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True))], names=["id", *_WINDOW])

    kept = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"id {kind}, code string, law_ord int, law_pos int, ref_pos int, articulo string, fraccion string, parrafo string, raw string")


_WINDOW = ("code", "law_ord", "law_pos", "ref_pos", "articulo", "fraccion", "parrafo", "raw")


# ---------------------------------------------------------------- resolution


def key_canon(c: Column) -> Column:
    """A case key without white space and periods, in upper case: the form in which two spellings of it agree."""
    return F.upper(F.regexp_replace(c, r"(?U)[\s.]+", ""))


def key_parts(canon: Column) -> Column:
    """struct(block, organ, epoch) of a canonical case key: what must agree, and what may be left out.

    A jurisprudence key (2A/J19/2021(11A)) is blocked by number and year; another by all but the epoch in brackets.
    """
    numbered = r"^([0-9A-Z]+)/?J(\d+/\d{4})(?:\((\d{1,2})A?\))?$"
    other = r"^(.*?)(?:\((\d{1,2})A?\))?$"

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(canon, pattern, group), F.lit(""))

    bare = r"^J(\d+/\d{4})(?:\((\d{1,2})A?\))?$"
    return (
        F.when(canon.rlike(bare), F.struct(F.concat(F.lit("J"), part(bare, 1)).alias("block"), F.lit(None).cast("string").alias("organ"), part(bare, 2).alias("epoch")))
        .when(canon.rlike(numbered), F.struct(F.concat(F.lit("J"), part(numbered, 2)).alias("block"), part(numbered, 1).alias("organ"), part(numbered, 3).alias("epoch")))
        .otherwise(F.struct(part(other, 1).alias("block"), F.lit(None).cast("string").alias("organ"), part(other, 2).alias("epoch")))
    )


def case_targets(docs: DataFrame, id_col: str, key_col: str, date_col: str | None = None) -> DataFrame:
    """(kind, block, organ, epoch, doc_id, date): documents by their own case key."""
    date = F.col(date_col) if date_col else F.lit(None)
    rows = docs.where(F.col(key_col).isNotNull() & (F.trim(key_col) != "")).select(F.col(id_col).alias("doc_id"), date.cast("date").alias("date"), key_parts(key_canon(F.col(key_col))).alias("p"))
    return rows.select(F.lit("tesis").alias("kind"), "p.block", "p.organ", "p.epoch", "doc_id", "date")


def law_targets(docs: DataFrame, id_col: str, title_col: str, date_col: str | None = None, laws: dict[str, str] = catalog.LAWS) -> DataFrame:
    """(kind, block, organ, epoch, doc_id, date): documents whose title begins with a law of the catalogue."""
    date = F.col(date_col) if date_col else F.lit(None)
    code = None
    for name, pattern in laws.items():
        fits = squeeze(title_col).rlike(rf"(?idU)^(?:{pattern})")
        code = F.when(fits, name) if code is None else code.when(fits, name)
    none = F.lit(None).cast("string")
    return docs.select(F.lit("ley").alias("kind"), code.alias("block"), none.alias("organ"), none.alias("epoch"), F.col(id_col).alias("doc_id"), date.cast("date").alias("date")).where("block is not null")


def resolve_citations(cites: DataFrame, targets: DataFrame, kind: str = "kind", cited: str = "cited", best: bool = False) -> DataFrame:
    """cites with norm_canon, cited_doc_id, candidate and candidates: the documents that a citation names, best first.

    ``cites`` has a kind (``tesis``: ``cited`` is a case key; ``ley``: it is a law's code) and any other columns.
    Candidates share the block of the canonical key; an organ or epoch that both sides have must agree, one that
    either leaves out may be anything. They are ranked by how many of these agree, then the latest date, then doc_id, so
    candidate 1 is the resolution and ``candidates`` above 1 says that it was ambiguous. A citation that nothing fits
    keeps one row with a null cited_doc_id and 0 candidates; a null or empty one has a null norm_canon, too.

    Each distinct citation is resolved once, and all its rows then look it up. With ``best`` they meet candidate 1 alone:
    otherwise a citation has as many rows as documents that it may name.
    """
    canon = F.when(F.col(kind) == "tesis", key_canon(F.col(cited))).otherwise(F.col(cited))
    rows = cites.withColumn("norm_canon", F.nullif(canon, F.lit("")))
    keys = rows.where("norm_canon is not null").select(F.col(kind).alias("kind"), "norm_canon").distinct()
    parts = key_parts(F.col("norm_canon"))
    alone = F.struct(F.col("norm_canon").alias("block"), F.lit(None).cast("string").alias("organ"), F.lit(None).cast("string").alias("epoch"))
    asked = keys.withColumn("p", F.when(F.col("kind") == "tesis", parts).otherwise(alone)).select("kind", "norm_canon", "p.*")
    met = asked.alias("a").join(targets.alias("t"), ["kind", "block"])
    same = [F.col(f"a.{c}") == F.col(f"t.{c}") for c in ("organ", "epoch")]
    met = met.where(F.coalesce(same[0], F.lit(True)) & F.coalesce(same[1], F.lit(True)))
    agree = sum((F.coalesce(s.cast("int"), F.lit(0)) for s in same), F.lit(0))
    ranked = met.select("kind", "norm_canon", "doc_id", "date", agree.alias("agree"))
    by = Window.partitionBy("kind", "norm_canon")
    ranked = ranked.withColumn("candidate", F.row_number().over(by.orderBy(F.desc("agree"), F.desc_nulls_last("date"), "doc_id"))).withColumn("candidates", F.count("*").over(by).cast("int"))
    found = ranked.select(F.col("kind").alias(kind), "norm_canon", F.col("doc_id").alias("cited_doc_id"), "candidate", "candidates")
    out = rows.join(found.where("candidate = 1") if best else found, [kind, "norm_canon"], "left")
    return out.withColumns({"candidates": F.coalesce("candidates", F.lit(0)), "candidate": F.coalesce("candidate", F.lit(1))}).select(*cites.columns, "norm_canon", "cited_doc_id", "candidate", "candidates")
