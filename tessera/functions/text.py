"""Text functions as Column expressions; all stay in the JVM and inside code generation."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

def _letters() -> tuple[str, str]:
    """Latin letters with marks and the single letters that compatibility decomposition makes of them."""
    bases = {}
    for point in (*range(0xAA, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(point) and base.isalnum():
            bases[chr(point)] = base
    return "".join(bases), "".join(bases.values())


_MARKED, _PLAIN = _letters()
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENTITIES = (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
#: Spanish month names.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rx(pattern: str, flags: str = "idU") -> str:
    """A pattern that matches as Unicode text regardless of case, with only newline as a line end."""
    return f"(?{flags}){pattern}" if flags else pattern


def first_match(c: Column | str, pattern: str, group: int = 0) -> Column:
    """The first match's group, null where nothing matches (regexp_extract gives an empty string)."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def first_of(c: Column | str, *choices: tuple[str, int]) -> Column:
    """The first pattern of a cascade that matches."""
    return F.coalesce(*[first_match(c, p, g) for p, g in choices])


def or_else(*columns: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in columns])


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends (trim only knows the space)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def ascii_lower(c: Column | str) -> Column:
    """Lower-cases A-Z alone, as SQLite's lower() and LIKE do."""
    return F.translate(_col(c), _UPPER, _LOWER)


def fold(c: Column | str) -> Column:
    """Lower case without marks, whether they are part of a letter or follow it."""
    return F.lower(F.translate(F.regexp_replace(_col(c), r"\p{Mn}", ""), _MARKED, _PLAIN))


def folded(text: str) -> str:
    """What ``fold`` makes of a single text."""
    bare = "".join(c for c in text if unicodedata.category(c) != "Mn")
    return bare.translate(str.maketrans(_MARKED, _PLAIN)).lower()


def normalize_name(c: Column | str) -> Column:
    """Folded, with anything but a-z, 0-9 and spaces turned to spaces, squeezed."""
    return squeeze(F.regexp_replace(fold(c), "[^a-z0-9 ]", " "))


def decode_entities(c: Column | str) -> Column:
    out = _col(c)
    for name, char in _ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def drop_blocks(c: Column | str, *tags: str) -> Column:
    """HTML without the given elements and what is in them."""
    return F.regexp_replace(_col(c), f"(?is)<({'|'.join(tags or ('script', 'style'))})\\b.*?</\\1\\s*>", "")


def text_only(c: Column | str, entities: bool = False) -> Column:
    """HTML's text: tags become spaces, white space is squeezed."""
    bare = F.regexp_replace(_col(c), "<[^>]+>", " ")
    return squeeze(decode_entities(bare) if entities else bare)


def parse_fecha(c: Column | str) -> Column:
    """A date from dd/MM/yyyy, yyyy-MM-dd or '12 de mayo de 2020'; null for anything else."""
    text = strip(c)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(text, r"(?iu)(\d{1,2})\s+de\s+([a-z]+)\s+(?:de|del)\s+(\d{4})", 2)))
    day, year = (F.regexp_extract(text, r"(?iu)(\d{1,2})\s+de\s+([a-z]+)\s+(?:de|del)\s+(\d{4})", g) for g in (1, 3))
    long_form = F.when(month > 0, F.try_to_date(F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"))
    return F.coalesce(F.try_to_date(text, "dd/MM/yyyy"), F.try_to_date(text, "yyyy-MM-dd"), long_form)


def basename(c: Column | str) -> Column:
    """The last part of a path, without its last extension."""
    return F.regexp_replace(F.element_at(F.split(_col(c), "/"), -1), r"\.[^.]*$", "")


def url_extension(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(c), r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1))


def absolutize(link: Column | str, base: str | Column) -> Column:
    """A link as an absolute URL, seen from the page ``base`` (one URL for all rows, or a column of them); ``../`` goes up
    one folder each, not above the host. Null where the link or the base is."""
    link, base = strip(link), F.lit(base) if isinstance(base, str) else base
    scheme, host = (F.regexp_extract(base, r"^([^:/?#]+)://([^/?#]*)", g) for g in (1, 2))
    root = F.concat(scheme, F.lit("://"), host)
    folders = F.filter(F.split(F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*/([^?#]*/)?", 1), "/"), lambda x: x != "")
    up = F.floor(F.length(F.regexp_extract(link, r"^((?:\.\./)*)", 1)) / 3).cast("int")
    kept = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - up, F.lit(0)))
    below = F.regexp_replace(link, r"^(?:(?:\.\./)+|\./)", "")
    return (
        F.when(link.rlike("(?i)^https?://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.array_join(F.concat(F.array(root), kept, F.array(below)), "/"))
    )


def name_from_url(c: Column | str) -> Column:
    """A readable title from a file's URL: decoded, without extension, hash or number before it, date and reference tail."""
    name = F.try_url_decode(F.replace(F.element_at(F.split(_col(c), "/"), -1), F.lit("+"), F.lit("%2B")))
    tails = (r"(?i)\.(pdf|docx?|html?)$", r"^[0-9a-fA-F]{6,40}_+", r"^[0-9]+_+", r"_\d{4}-\d{2}-\d{2}$", r"(?iU)\s*\([^)]*ref[^)]*\)\s*$")
    for pattern in tails:
        name = F.regexp_replace(name, pattern, "")
    return squeeze(F.translate(name, "-_", "  "))


def title_of(c: Column | str, words: str, head: int = 3000, most: int = 300) -> Column:
    """A law's title from the head of its text: from one of ``words`` on, cut before 'Última Reforma' and, where it is
    long, at its first period."""
    found = squeeze(first_match(F.substring(_col(c), 1, head), rx(rf"((?:{words})\s+[A-ZÁÉÍÓÚÑÜ\d\s,\-\.\(\)/]{{15,250}})"), 1))
    found = F.regexp_replace(found, r"(?U)\s+[ÚU]ltima\s+[Rr]eforma.*$", "")
    return F.substring(F.when(F.length(found) > 50, F.split_part(found, F.lit("."), F.lit(1))).otherwise(found), 1, most)


def first_word(c: Column | str) -> Column:
    return F.split(_col(c), " ")[0]


def truncated(c: Column | str, n: int = 24_000) -> Column:
    return F.substring(_col(c), 1, n)


def join_names(c: Column | str, field: str | None = None) -> Column:
    """An array of strings or of structs' ``field`` as one string."""
    return F.array_join(F.transform(_col(c), lambda x: x[field]) if field else _col(c), ", ")


def flatten_fields(c: Column | str) -> Column:
    """A map of texts as '[key]' lines, each over its value, parted by blank lines; empty values are left out."""
    kept = F.map_filter(_col(c), lambda k, v: v.isNotNull() & (v != ""))
    return F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat(F.lit("["), e["key"], F.lit("]\n"), e["value"])), "\n\n")


def total_length(c: Column | str, field: str | None = None) -> Column:
    return F.aggregate(_col(c), F.lit(0), lambda a, x: a + F.coalesce(F.length(x[field] if field else x), F.lit(0)))


def ordered_case(c: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first keyword that the text contains."""
    out = None
    for word, value in rules:
        out = F.when(c.contains(word), value) if out is None else out.when(c.contains(word), value)
    return out.otherwise(default)


def keyword_class(columns: list[Column | str], rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first pattern that matches the columns taken together; nulls are skipped."""
    text = F.concat_ws(" ", *[_col(c) for c in columns])
    out = None
    for pattern, value in rules:
        out = F.when(text.rlike(pattern), value) if out is None else out.when(text.rlike(pattern), value)
    return out.otherwise(default)


def clave_parts(c: Column | str) -> tuple[Column, Column]:
    """(epoch, chamber) of a hyphenated case key; the chamber needs three parts."""
    parts = F.split(_col(c), "-")
    return parts[0], F.when(F.size(parts) >= 3, parts[2])
