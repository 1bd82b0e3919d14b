"""SentencePiece encoding and decoding of whole texts with numpy.

Words (a run of word marks and what follows up to the next) are encoded in batches of equal length. The hashes of all
their substrings, from prefix sums, probe the sorted keys of the pieces once. Over that table of piece numbers

* unigram models run Viterbi, all words of a batch one position at a time: a maximum over the pieces that end there
  gives each word's best score and backpointer;
* BPE models can't be segmented that way (the best sum of scores isn't what merging gives), so they merge: in every
  round each word's best adjacent pair, again a maximum over the batch, becomes one symbol.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_field
from .hashing import U64, mix, slices
from .piece_store import PieceStore

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BASE = U64(0x9E3779B97F4A7C15)
#: Words beyond this length merge one by one with a heap, as rounds over them would cost the square of the length.
_LONG = 128
_UNKNOWN_PENALTY = 10.0


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE, U64)
    steps[0] = 1
    return np.cumprod(steps, dtype=U64)


def _point_codes(points: np.ndarray) -> np.ndarray:
    return mix((points.astype(U64) + U64(1)) * U64(0xD6E8FEB86659FD93))


class Codec(PieceStore):
    """A SentencePiece model with an identity normaliser, as numpy arrays.

    ``kind`` is "bpe" or "unigram" and normally read from the model file.
    """

    def __init__(self, path: str, kind: str | None = None, most: int = 200_000):
        super().__init__(most)
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that leave texts as they are, with a word mark before them, are supported")
        self.kind = kind or {1: "unigram", 2: "bpe"}[model.trainer_spec.model_type]
        self.unknown = SentencePieceProcessor(model_file=path).unk_id()
        plain = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == 1]
        if any(MARK in p.lstrip(MARK) for _, p, _ in plain):
            raise ValueError("pieces that go on over a word mark aren't supported")
        self.longest = max(len(p) for _, p, _ in plain)
        self.scores = np.array([p.score for p in model.pieces], np.float32)
        with np.errstate(over="ignore"):
            power = _powers(self.longest)
            keys = np.array([mix(np.array([(_point_codes(np.array([*map(ord, p)])) * power[: len(p)]).sum(dtype=U64)]))[0] for _, p, _ in plain], U64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([i for i, _, _ in plain], np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same hash")
        self.byte_ids = np.full(256, -1, np.int64)
        surface = []
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
            surface.append(bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(MARK, " ").encode() if p.type == 1 else " ⁇ ".encode() if p.type == 2 else b"")
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_ends = np.concatenate([[0], np.cumsum([len(s) for s in surface])])

    # ------------------------------------------------------------ encoding

    def cut(self, text: str) -> list[str]:
        return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def piece_table(self, points: np.ndarray) -> np.ndarray:
        """Piece ids [words, start, length - 1] of all substrings of equally long words; -1 where there is no piece."""
        n, size = points.shape
        with np.errstate(over="ignore"):
            power, inverse = _powers(size), np.cumprod(np.concatenate([[U64(1)], np.full(size, U64(pow(int(_BASE), -1, 1 << 64)), U64)]), dtype=U64)
            sums = np.zeros((n, size + 1), U64)
            np.cumsum(_point_codes(points) * power[:size], axis=1, out=sums[:, 1:])
            table = np.full((n, size, min(self.longest, size)), -1, np.int32)
            for k in range(table.shape[2]):
                probe = mix((sums[:, k + 1 :] - sums[:, : size - k]) * inverse[: size - k])
                place = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
                table[:, : size - k, k] = np.where(self.keys[place] == probe, self.key_ids[place], -1)
        return table

    def viterbi(self, table: np.ndarray) -> np.ndarray:
        """Length of the piece that ends at each position on the best path, 0 elsewhere: [words, size]."""
        n, size, most = table.shape
        rows = np.arange(n)
        unknown = np.float32(self.scores[self.key_ids].min() - _UNKNOWN_PENALTY)
        best = np.full((n, size + 1), -np.inf, np.float32)
        best[:, 0] = 0
        back = np.zeros((n, size + 1), np.int32)
        for end in range(1, size + 1):
            lengths = np.arange(min(most, end), 0, -1)  # ties go to the longer piece, as in the library
            ids = table[:, end - lengths, lengths - 1]
            gain = np.where(ids >= 0, self.scores[ids], -np.inf).astype(np.float32)
            gain[:, -1] = np.where(ids[:, -1] >= 0, gain[:, -1], unknown)
            total = best[:, end - lengths] + gain
            pick = total.argmax(axis=1)
            best[:, end], back[:, end] = total[rows, pick], lengths[pick]
        out = np.zeros((n, size), np.int32)
        at = np.full(n, size)
        while (at > 0).any():
            live = at > 0
            out[rows[live], at[live] - 1] = back[rows[live], at[live]]
            at = at - np.where(live, back[rows, at], 0)
        return out

    def merge(self, table: np.ndarray) -> np.ndarray:
        """The same for BPE: rounds of each word's best pair, the leftmost on ties."""
        n, size, most = table.shape
        end = np.tile(np.arange(1, size + 1), (n, 1))
        start = np.ones((n, size), bool)
        places = np.arange(size)
        live = np.arange(n)
        while len(live) and size > 1:
            e = end[live]
            after = np.take_along_axis(e, np.minimum(e, size - 1), axis=1)
            width = after - places
            ok = start[live] & (e < size) & (width <= most)
            ids = table[live[:, None], places, np.where(ok, width, 1) - 1]
            gain = np.where(ok & (ids >= 0), self.scores[ids], -np.inf)
            pick = gain.argmax(axis=1)
            found = gain[np.arange(len(live)), pick] > -np.inf
            live, pick, e, after = live[found], pick[found], e[found], after[found]
            row = np.arange(len(live))
            start[live, e[row, pick]] = False
            end[live, pick] = after[row, pick]
        out = np.zeros((n, size), np.int32)
        rows, cols = np.nonzero(start)
        out[rows, end[rows, cols] - 1] = end[rows, cols] - cols
        return out

    def merge_long(self, table: np.ndarray) -> np.ndarray:
        """merge() for one long word [size, lengths], by a heap of pairs."""
        size, most = table.shape
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))
        alive = [True] * size
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < size and end[end[i]] - i <= most and table[i, end[end[i]] - i - 1] >= 0:
                heapq.heappush(heap, (-float(self.scores[table[i, end[end[i]] - i - 1]]), i, end[i], end[end[i]]))

        for i in range(size):
            offer(i)
        while heap:
            _, i, middle, last = heapq.heappop(heap)
            if alive[i] and end[i] == middle and alive[middle] and end[middle] == last:
                end[i], alive[middle] = last, False
                if last < size:
                    before[last] = i
                offer(i)
                offer(before[i])
        out = np.zeros((1, size), np.int32)
        for i in range(size):
            if alive[i]:
                out[0, end[i] - 1] = end[i] - i
        return out

    def learn(self, fresh: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        order, flat, sizes = [], [], []
        by_size: dict[int, list[str]] = {}
        for w in fresh:
            by_size.setdefault(len(w), []).append(w)
        for size, group in sorted(by_size.items()):
            step = max(1, 400_000 // (size * min(size, self.longest)))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), size)
                table = self.piece_table(points)
                if self.kind == "unigram":
                    lengths = self.viterbi(table)
                elif size > _LONG:
                    lengths = np.concatenate([self.merge_long(t) for t in table])
                else:
                    lengths = self.merge(table)
                rows, ends = np.nonzero(lengths)
                own = lengths[rows, ends]
                ids = table[rows, ends - own + 1, own - 1].astype(np.int64)
                count = np.ones(len(ids), np.int64)
                if (ids < 0).any():
                    ids, count = self._bytes(points, rows, ends, ids)
                order += part
                flat.append(ids.astype(np.uint32))
                sizes.append(np.bincount(rows, count, len(part)).astype(np.int64))
        return order, np.concatenate(flat), np.concatenate(sizes)

    def _bytes(self, points: np.ndarray, rows: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the pieces of their UTF-8 bytes, or the unknown piece without those."""
        out, count = [], np.ones(len(ids), np.int64)
        for k, i in enumerate(ids.tolist()):
            if i >= 0:
                out.append(i)
            elif (self.byte_ids < 0).any():
                out.append(self.unknown)
            else:
                raw = chr(int(points[rows[k], ends[k]])).encode("utf-8", "replace")
                out += self.byte_ids[list(raw)].tolist()
                count[k] = len(raw)
        return np.array(out, np.int64), count

    # ------------------------------------------------------------ decoding

    def decode(self, texts: list[np.ndarray]) -> list[str]:
        """The texts that ids stand for: pieces joined, marks as spaces, the first word's own mark dropped."""
        ids = np.concatenate(texts).astype(np.int64) if texts else np.zeros(0, np.int64)
        first = self.surface_ends[ids]
        sizes = self.surface_ends[ids + 1] - first
        stops = np.cumsum(sizes)
        raw = self.surface[np.repeat(first - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)].tobytes()
        cuts = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)].tolist()
        out = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return [t[1:] if t.startswith(" ") else t for t in out]


@lru_cache(maxsize=2)
def codec_of(path: str, kind: str | None = None) -> Codec:
    """One codec a Python worker; what it has stored serves the worker's next tasks too."""
    return Codec(path, kind)


def _encoded(path: str, kind: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, kind)
        for batch in batches:
            for at, end, _, _ in slices(batch.column("text")):
                part = batch.slice(at, end - at)
                got = codec.encode(["" if t is None else t for t in part.column("text").to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(g) for g in got])]), pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(got).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "ids"])

    return run


def _decoded(path: str, kind: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, kind)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids = [np.zeros(0, np.int64) if x.values is None else x.values.to_numpy(zero_copy_only=False) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(codec.decode(ids), pa.string())], names=[*part.schema.names, "decoded"])

    return run


def encode_texts(docs: DataFrame, path: str, kind: str | None = None) -> DataFrame:
    """docs with ``ids`` (array<int>) added: the pieces of the whole text. Null and empty texts have none.

    All other columns stay; a column named ids is replaced. Long words without spaces are encoded whole.
    """
    kept = docs.drop("ids")
    return kept.mapInArrow(_encoded(path, kind), with_field(kept, "ids", "array<int>"))


def decode_ids(encoded: DataFrame, path: str, kind: str | None = None) -> DataFrame:
    """``decoded`` (string) added: what the ids stand for. Null ids count as none."""
    kept = encoded.drop("decoded")
    return kept.mapInArrow(_decoded(path, kind), with_field(kept, "decoded", "string"))


def round_trips(docs: DataFrame, path: str, kind: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_crc32, decoded_chars, round_trip.

    Texts are encoded and what the ids stand for is compared with them: round_trip says that decoding gave the text
    back (a word mark in a text comes back as a space, and a null text as an empty one). ids_crc32 is over the ids as
    little-endian 32-bit integers. A null doc_id is kept, repeated rows are encoded each, an empty table gives no rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, kind)
        for batch in batches:
            for at, end, _, _ in slices(batch.column("text")):
                part = batch.slice(at, end - at)
                texts = ["" if t is None else t for t in part.column("text").to_pylist()]
                ids = codec.encode(texts)
                back = codec.decode(ids)
                columns = [
                    part.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([len(t) for t in back], pa.int64()),
                    pa.array([b == t.replace(MARK, " ") for b, t in zip(back, texts, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_crc32", "decoded_chars", "round_trip"])

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(digest, f"doc_id {kind_of_id}, n_tokens long, ids_crc32 long, decoded_chars long, round_trip boolean")
