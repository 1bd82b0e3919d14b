"""Language-model scores by an interpolated modified Kneser-Ney n-gram model of the corpus.

A pass over the texts for each order, from the highest down, shuffles packed runs of numbers instead of rows. Every
task adds up by 64-bit hash what a gram needs; the runs are dealt by hash range, and each range becomes one file of
sorted arrays in the shared folder, which later passes and the scoring map.

The highest order needs counts. A lower one needs, besides its counts, how many different tokens come before a gram,
and as a context how much its followers have in all and leave to back off with. With the next order's files mapped, a
gram that is seen c times adds 1/c of these at each occurrence, so they come from the same kind of sum. Shares are
whole multiples of 2**-32, so sums don't depend on their order. Grams seen once need no numbers at all: they have one
token before and one after.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, new_path
from .hashing import U64, mix, slices, span_hashes, word_spans

START, END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
HELD_OUT, FOLDS = 2, 7
ORDER = 3
#: Bytes of text a range of hashes is made for, and how many distinct grams a task gathers before it passes them on.
RANGE_BYTES, MOST_GATHERED = 32 << 20, 2_000_000
#: Ranges of an order that a task keeps mapped, the most parts a shuffle has, and bytes of text looked up together.
MOST_OPEN, MOST_PARTS, TOGETHER = 256, 8192, 1 << 20
_ONE = 1 << 32
_FALLBACK = np.array([0.0, 0.5, 1.0, 1.5])


def mounted(path: str) -> str:
    """The path as tasks open it. Memory-mapped files need a shared folder that every machine has mounted."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"the model's files are memory-mapped: spark.checkpoint.dir must be a mounted folder, not {path}")
    return url.path or path


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, its place in its text, number of its text): a start, the words with A-Z lower-cased, and an end."""
    starts, ends, text = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    n = len(offsets) - 1
    many = np.bincount(text, minlength=n) + 2
    first = np.cumsum(many) - many
    token = np.empty(int(many.sum()), U64)
    token[first], token[first + many - 1] = START, END
    token[np.arange(len(words)) + 2 * text + 1] = words
    owner = np.repeat(np.arange(n), many)
    return token, np.arange(len(token)) - first[owner], owner


def gram_hashes(token: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the grams of 1 to ``order`` tokens that end at each place; those that reach into another text are void."""
    out = [token]
    for k in range(1, order):
        before = np.concatenate([np.zeros(k, U64), token[:-k]]) if len(token) > k else np.zeros(len(token), U64)
        shorter = out[-1]
        out.append(mix(before * U64(0x9DDFEA08EB382D69) + (shorter ^ (shorter >> U64(29))) * U64(0xC3A5C85C97CB3127)))
    return out


# ---------------------------------------------------------------- runs


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of each of the values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    return (keys[at], *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values))


def _squeezed(x: np.ndarray) -> bytes:
    """Bytes of like weight together, compressed."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unsqueezed(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def _numbered(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row of values, the different rows one after another): few rows differ, whatever they hold."""
    if len(values) == 1:
        return values[0], np.zeros(0, np.int64)
    names = np.zeros(len(values[0]), U64)
    for k, v in enumerate(values):
        names = mix(names ^ (v.view(U64) + U64(k)))
    _, first, numbers = np.unique(names, return_index=True, return_inverse=True)
    return numbers.astype(np.int64), np.stack([v[first] for v in values]).ravel()


def _ranges(bits: int, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """One row a range of hashes (the top bits) with the sorted keys in it, as steps, and their values, numbered."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=U64) << U64(64 - bits)) if bits else np.zeros(0, np.int64)
    cuts = np.concatenate([[0], cuts, [len(keys)]])
    full = np.flatnonzero(np.diff(cuts))
    rows = {c: [] for c in ("part", "n", "keys", "numbers", "kinds", "table")}
    for i in full.tolist():
        own = slice(cuts[i], cuts[i + 1])
        numbers, table = _numbered([v[own] for v in values])
        row = (i, len(numbers), _squeezed(np.diff(keys[own], prepend=U64(0))), _squeezed(numbers), len(table), _squeezed(table))
        for c, v in zip(rows, row, strict=True):
            rows[c].append(v)
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()), strict=True)], names=list(rows))


_RUN = "part int, n long, keys binary, numbers binary, kinds long, table binary"


def _gathered(table: pa.Table, n_values: int) -> tuple[np.ndarray, ...]:
    """Keys and values of the runs of a range, summed."""
    parts = []
    for row in table.select(["n", "keys", "numbers", "kinds", "table"]).to_pylist():
        keys = np.cumsum(_unsqueezed(row["keys"], row["n"]).view(U64), dtype=U64)
        numbers = _unsqueezed(row["numbers"], row["n"])
        parts.append((keys, *(v[numbers] for v in _unsqueezed(row["table"], row["kinds"]).reshape(n_values, -1))) if n_values > 1 else (keys, numbers))
    return _summed(*map(np.concatenate, zip(*parts, strict=True)))


def _runs(level: int, bits: int, model: Model):
    """By gram of ``level`` tokens: its count and, below the highest order, tokens before it and what it is as a context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = Level(model, level + 1) if level < model.order else None
        gathered: list[tuple[np.ndarray, ...]] = []
        size = 0
        with np.errstate(over="ignore"):
            for batch in batches:
                for _, _, data, offsets in slices(batch.column("text"), TOGETHER):
                    gathered.append(_occurrences(level, model, above, data, offsets))
                    size += len(gathered[-1][0])
                    if size > MOST_GATHERED:
                        gathered = [_summed(*map(np.concatenate, zip(*gathered, strict=True)))]
                        size = len(gathered[0][0])
                        if size > MOST_GATHERED // 2:
                            yield _ranges(bits, *gathered[0])
                            gathered, size = [], 0
            if gathered:
                yield _ranges(bits, *_summed(*map(np.concatenate, zip(*gathered, strict=True))))

    return run


def _occurrences(level: int, model: Model, above: Level | None, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    token, place, _ = tokens(data, offsets)
    hashes = gram_hashes(token, min(level + 1, model.order))
    own = np.flatnonzero(place >= max(level - 1, 1))
    keys = hashes[level - 1][own]
    if above is None:
        return _summed(keys, np.ones(len(keys), np.int64))
    longer = np.flatnonzero(place >= level)
    names, back = np.unique(hashes[level][longer], return_inverse=True)
    count, adjusted = (x[back] for x in above.grams(names))
    share = _ONE // count + (2 * (_ONE % count) >= count)
    # a gram at the start of its text has nothing before it: it goes by its count
    before = np.full(len(token), _ONE, np.int64)
    before[longer] = share
    given_up = model.discounts[level + 1][np.minimum(adjusted, 3)]
    nothing, none = np.zeros(len(own), np.int64), np.zeros(len(longer), np.int64)
    values = [
        np.concatenate([np.ones(len(own), np.int64), none]),
        np.concatenate([before[own], none]),
        np.concatenate([nothing, np.rint(given_up * _ONE / count).astype(np.int64)]),
    ]
    if model.has_total(level):
        values.append(np.concatenate([nothing, np.rint(adjusted * (_ONE / count)).astype(np.int64)]))
    return _summed(np.concatenate([keys, hashes[level - 1][longer - 1]]), *values)


# ---------------------------------------------------------------- files


def _directory(keys: np.ndarray, bits: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits of the directory, where each of its entries begins, 32 more bits of each key) of a range's sorted keys."""
    more = max(0, len(keys) >> 5).bit_length()
    rest = keys << U64(bits)
    entry = (rest >> U64(64 - more)).astype(np.int64) if more else np.zeros(len(keys), np.int64)
    begins = np.searchsorted(entry, np.arange((1 << more) + 1)).astype(np.uint32)
    return more, begins, ((rest << U64(more)) >> U64(32)).astype(np.uint32)


def _counted(x: np.ndarray) -> list[np.ndarray]:
    """Numbers in a byte each; larger ones listed apart by place."""
    large = np.flatnonzero(x >= 255)
    return [np.minimum(x, 255).astype(np.uint8), large.astype(np.int64), x[large].astype(np.int64)]


def _write_file(path: str, arrays: list[np.ndarray]) -> None:
    """Arrays after a list of their lengths; whole or not at all, so a task that is run again replaces it by the same."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as f:
        np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tofile(f)
        for a in arrays:
            f.write(a.tobytes() + bytes(-a.nbytes % 8))
    os.replace(draft, path)


def _whole(x: np.ndarray) -> np.ndarray:
    return (x + _ONE // 2) >> 32


def _write_range(folder: str, level: int, bits: int, top: bool, has_total: bool):
    """One range of hashes as a file, and what discounts need to know of it."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        with np.errstate(over="ignore"):
            keys, count, *shares = _gathered(table, 1 if top else 3 + has_total)
        adjusted = count if top else _whole(shares[0])
        single = (count == 1) if level > 1 else np.zeros(len(keys), bool)
        arrays = []
        for some in (single, ~single):
            more, begins, low = _directory(keys[some], bits)
            arrays += [np.array([more], np.int64), begins, low]
        arrays += _counted(count[~single])
        if not top:
            arrays += [*_counted(adjusted[~single]), (shares[1][~single] / _ONE).astype(np.float32)]
            if has_total:
                arrays += _counted(_whole(shares[2])[~single])
        _write_file(f"{folder}/{level}-{part:07d}", arrays)
        some = np.bincount(np.minimum(adjusted, 5).astype(np.int64), minlength=6)
        row = {"part": part, "grams": int((count > 0).sum()), "count": int(count.sum()), "adjusted": int(adjusted.sum()), **{f"n{i}": int(some[i]) for i in range(1, 5)}, "n5": int(some[5])}
        return pa.table({k: pa.array([v], pa.int32() if k == "part" else pa.int64()) for k, v in row.items()})

    return run


class Level:
    """The files of one order, each mapped when first asked for; the longest unused ones are let go."""

    def __init__(self, model: Model, level: int):
        self.model, self.level, self.bits, self.there = model, level, model.bits[level], model.parts[level]
        self.open: OrderedDict[int, list] = OrderedDict()

    def _range(self, part: int) -> list | None:
        if not self.there[part]:
            return None
        if part in self.open:
            self.open.move_to_end(part)
            return self.open[part]
        if len(self.open) >= MOST_OPEN:
            self.open.popitem(last=False)
        path = f"{self.model.folder}/{self.level}-{part:07d}"
        if not os.path.exists(path):
            raise FileNotFoundError(f"{path}: the model was written, but its folder isn't shared with this machine")
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view(np.int64)[0])
        sizes = raw[8 : 8 + 8 * n].view(np.int64)
        at, parts = 8 + 8 * n, []
        for size in sizes.tolist():
            parts.append(raw[at : at + size])
            at += size + -size % 8
        kinds = [np.int64, np.uint32, np.uint32] * 2 + [np.uint8, np.int64, np.int64]
        if self.level < self.model.order:
            kinds += [np.uint8, np.int64, np.int64, np.float32] + [np.uint8, np.int64, np.int64] * self.model.has_total(self.level)
        self.open[part] = [p.view(kind) for p, kind in zip(parts, kinds, strict=True)]
        return self.open[part]

    def _find(self, keys: np.ndarray, more: np.ndarray, begins: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are there, their places), by a search within each key's entry of the directory."""
        if not len(low) or not len(keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        more, rest = int(more[0]), keys << U64(self.bits)
        entry = (rest >> U64(64 - more)).astype(np.int64) if more else np.zeros(len(keys), np.int64)
        want = ((rest << U64(more)) >> U64(32)).astype(np.uint32)
        a, end = begins[entry].astype(np.int64), begins[entry + 1].astype(np.int64)
        b = end
        for _ in range(int((b - a).max()).bit_length()):
            middle = np.minimum((a + b) >> 1, len(low) - 1)
            less = (low[middle] < want) & (a < b)
            a, b = np.where(less, middle + 1, a), np.where(less, b, np.minimum(b, np.maximum(middle, a)))
        place = np.minimum(a, len(low) - 1)
        return (a < end) & (low[place] == want), place

    def look_up(self, keys: np.ndarray, columns: tuple[str, ...]) -> list[np.ndarray]:
        """For sorted distinct hashes: of "count", "adjusted", "total" and "spare" those asked for; zeros for unknown grams."""
        out = [np.zeros(len(keys), float if c == "spare" else np.int64) for c in columns]
        ids = (keys >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        cuts = np.flatnonzero(np.diff(ids, prepend=-1, append=1 << 62))
        top, once = self.level == self.model.order, None if self.level == self.model.order else self.model.discounts[self.level + 1][1]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            arrays = self._range(int(ids[a]))
            if arrays is None:
                continue
            single, _ = self._find(keys[a:b], *arrays[:3])
            left = np.flatnonzero(~single)
            there, place = self._find(keys[a:b][left], *arrays[3:6])
            left, place = a + left[there], place[there]
            for x, c in zip(out, columns, strict=True):
                x[a:b][single] = once if c == "spare" else 1
                if c == "spare":
                    x[left] = arrays[12][place]
                elif c == "count" or top or (c == "total" and not self.model.has_total(self.level)):
                    x[left] = _read(place, *arrays[6:9])
                else:
                    x[left] = _read(place, *(arrays[9:12] if c == "adjusted" else arrays[13:16]))
        return out

    def grams(self, keys: np.ndarray) -> list[np.ndarray]:
        return self.look_up(keys, ("count", "adjusted"))


def _read(place: np.ndarray, small: np.ndarray, large_place: np.ndarray, large: np.ndarray) -> np.ndarray:
    got = small[place].astype(np.int64)
    big = np.flatnonzero(got == 255)
    if len(big):
        got[big] = large[np.searchsorted(large_place, place[big])]
    return got


# ---------------------------------------------------------------- model


def discounts(n: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2 and 3 or more give up, from how many have the counts 1 to 4."""
    n1, n2, n3, n4 = n
    if min(n1, n2, n3) == 0:
        return _FALLBACK
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return d if (d[1:] > 0).all() and (d <= np.arange(4)).all() else _FALLBACK


class Model:
    """What scoring needs besides the files: their ranges, the discounts by order, and sums over all words."""

    def __init__(self, folder: str, order: int):
        self.folder, self.order = folder, order
        self.bits: dict[int, int] = {}
        self.parts: dict[int, np.ndarray] = {}
        self.discounts: dict[int, np.ndarray] = {}
        self.words = self.tokens = self.kinds = 0
        self.unseen = 1.0

    def has_total(self, level: int) -> bool:
        """Elsewhere what follows a gram is as many tokens as its count says."""
        return level == 1 or level < self.order - 1

    def add(self, level: int, bits: int, made: list) -> None:
        self.bits[level], self.parts[level] = bits, np.zeros(1 << bits, bool)
        self.parts[level][[r["part"] for r in made]] = True
        total = {c: sum(r[c] for r in made) for c in _SUMS}
        d = self.discounts[level] = discounts([total[f"n{i}"] for i in range(1, 5)])
        if level == 1:
            self.words, self.tokens, self.kinds = total["grams"], total["count"], total["adjusted"]
            spare = d[1] * total["n1"] + d[2] * total["n2"] + d[3] * (total["n3"] + total["n4"] + total["n5"])
            self.unseen = (spare / self.kinds if self.kinds else 1.0) / (self.words + 1)

    def score(self, data: np.ndarray, offsets: np.ndarray, levels: dict[int, Level]) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, score) of each text."""
        n = len(offsets) - 1
        token, place, owner = tokens(data, offsets)
        hashes = gram_hashes(token, self.order)
        names, back = np.unique(token, return_inverse=True)
        count, adjusted, total, spare = (x[back] for x in levels[1].look_up(names, ("count", "adjusted", "total", "spare")))
        chance = np.maximum(adjusted - self.discounts[1][np.minimum(adjusted, 3)], 0) / max(self.kinds, 1) + self.unseen
        for k in range(2, self.order + 1):
            at = np.flatnonzero(place >= k - 1)
            names, back = np.unique(hashes[k - 1], return_inverse=True)
            got = levels[k].look_up(names, ("adjusted",) if k == self.order else ("adjusted", "total", "spare"))
            got = [x[back] for x in got]
            own, all_, kept = got[0][at], total[at - 1], spare[at - 1]
            with np.errstate(invalid="ignore", divide="ignore"):
                better = (np.maximum(own - self.discounts[k][np.minimum(own, 3)], 0) + kept * chance[at]) / all_
            chance[at] = np.where(all_ > 0, better, chance[at])
            if k < self.order:
                total, spare = got[1], got[2]
                total[place < k - 1] = 0
        said = place > 0
        owner, count = owner[said], count[said]
        base = np.log10((count + 1) / (self.tokens + self.words + 1))
        return np.bincount(owner, minlength=n), np.bincount(owner[count > 0], minlength=n), np.bincount(owner, base, n), np.bincount(owner, np.log10(chance[said]), n)


_SUMS = ("grams", "count", "adjusted", "n1", "n2", "n3", "n4", "n5")


def fit(docs: DataFrame, training, folder: str | None = None, order: int = ORDER) -> Model:
    """Count the texts that ``training`` (a Column) keeps; all of them, with no pruning. Files go to ``folder``.

    The driver gets one row of sums a range of hashes.
    """
    spark: SparkSession = docs.sparkSession
    model = Model(mounted(folder or new_path(spark, "ngrams")), order)
    os.makedirs(model.folder, exist_ok=True)
    texts = docs.where(training).select("text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    most = max(0, int(size - 1) // RANGE_BYTES).bit_length() if size else 0
    for level in range(order, 0, -1):
        bits = most if level > 1 else max(0, most - 1)  # there are fewer words than longer grams
        runs = texts.mapInArrow(_runs(level, bits, model), _RUN)
        # as many parts as the ranges need, whatever the session's setting
        dealt = runs.repartition(min(2 << bits, MOST_PARTS), "part").groupBy("part")
        made = dealt.applyInArrow(_write_range(model.folder, level, bits, level == order, model.has_total(level)), "part int, " + ", ".join(f"{c} long" for c in _SUMS))
        model.add(level, bits, made.collect())
    return model


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = {k: Level(model, k) for k in range(1, model.order + 1)}
        with np.errstate(over="ignore"):
            for batch in batches:
                for at, end, data, offsets in slices(batch.column("text"), TOGETHER):
                    n_tokens, n_known, base, score = model.score(data, offsets, levels)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(at, end - at), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(np.round(base, 9)), pa.array(np.round(score, 9))],
                        names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                    )

    return run


def score_texts(docs: DataFrame, folder: str | None = None, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    The model learns from all documents outside the held-out fold (those with a null doc_id are held out). score is
    the log10 probability of the whole text with its end mark, base_score the same by add-one word frequencies.
    Null and empty texts are an end mark alone; repeated rows count and are scored each; an empty table gives no rows,
    and without training documents every token has the probability one; other columns are never read.
    """
    held = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True))
    model = fit(docs, ~held, folder, order)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_scores(model), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
