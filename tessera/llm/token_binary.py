"""Token ids as directly addressable codes.

A file of ids is a Parquet table of shards in ascending doc_id order; a shard holds the ids of whole documents. Inside
a shard the ids are cut into chunks of eight bits. Level k has the k-th chunk of every id that has one, a bitmap that
says which of them go on to the next level, and a directory of ranks over the bitmap. The rank of an id's bit is its
place on the next level, so any id is found from a few bytes and no block is decoded.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .hashing import slices
from .piece_store import PieceStore

_MAGIC = b"DAC1"
_BLOCK = 64  # bytes of bitmap a rank covers
SHARD_IDS = 1 << 18
END_ID = 2
_SHARD = "part int, seq int, doc_ids array<long>, lengths array<long>, n_tokens long, codes binary"


# ---------------------------------------------------------------- codes


def pack(ids: np.ndarray) -> bytes:
    """The codes of an array of ids below 2**32."""
    rest = np.asarray(ids, np.uint32)
    levels = []
    while True:
        chunks, rest = (rest & 0xFF).astype(np.uint8), rest >> 8
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % _BLOCK))
        ones = np.unpackbits(bits).reshape(-1, _BLOCK * 8).sum(axis=1, dtype=np.uint64) if len(bits) else np.zeros(0, np.uint64)
        ranks = np.concatenate([[np.uint64(0)], np.cumsum(ones, dtype=np.uint64)])[:-1] if len(ones) else ones
        levels.append((chunks, bits, ranks))
        if not more.any():
            break
        rest = rest[more]
    head = _MAGIC + np.array([len(levels), *[len(c) for c, _, _ in levels]], "<u8").tobytes()
    return head + b"".join(c.tobytes() + b.tobytes() + r.astype("<u8").tobytes() for c, b, r in levels)


class Codes:
    """Packed ids, addressed in place."""

    def __init__(self, packed: bytes):
        if packed[:4] != _MAGIC:
            raise ValueError("not a run of directly addressable codes")
        n_levels = int(np.frombuffer(packed, "<u8", 1, 4)[0])
        sizes = np.frombuffer(packed, "<u8", n_levels, 12).astype(int)
        at, self.levels = 12 + 8 * n_levels, []
        for n in sizes.tolist():
            n_bits = -(-(-(-n // 8)) // _BLOCK) * _BLOCK
            chunks = np.frombuffer(packed, np.uint8, n, at)
            bits = np.frombuffer(packed, np.uint8, n_bits, at + n)
            ranks = np.frombuffer(packed, "<u8", n_bits // _BLOCK, at + n + n_bits)
            self.levels.append((chunks, bits, ranks))
            at += n + n_bits + 8 * len(ranks)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """The i-th id, from one chunk, one bit and one rank a level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            block = byte // _BLOCK
            before = int.from_bytes(bits[block * _BLOCK : byte].tobytes() + bytes([int(bits[byte]) & ((1 << bit) - 1)]), "little").bit_count()
            i = int(ranks[block]) + before
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        value, places = None, None
        for k, (chunks, bits, _) in enumerate(self.levels):
            if value is None:
                value, places = chunks.astype(np.uint32), np.arange(len(chunks))
            else:
                value[places] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            places = places[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return value


# ---------------------------------------------------------------- encoding

# How byte-level BPE vocabularies of this kind cut texts before merging, for the characters below U+0250
# and common punctuation; in texts with others the library cuts.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r" \t\n\r\x0b\x0c"
# What is most frequent comes first; of the alternatives only those that share a first character depend on their order.
_PRETOKEN = re.compile(f" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_OTHER = re.compile(r"[^\x00-\x1b!-~ \xa1-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
#: Any such tokenizer may be cut where white space follows something else.
_PIECE = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
#: White space or not by some definitions only: texts with these are encoded whole.
_UNSURE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff]")


def _byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte: itself where it is one, else the next from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_characters()
_ID = attrgetter("id")
#: Between pieces that are translated together: a character that no familiar text has, and what becomes of it.
_BETWEEN = "\uffff"
_BETWEEN_BYTES = _BETWEEN.encode().decode("latin-1").translate(_BYTES)


def _is_familiar(text: str) -> bool:
    return not _OTHER.search(text) and "<|" not in text


def _is_plain(spec: dict) -> bool:
    """Whether a tokenizer's file says that it cuts as above: byte level, nothing normalised, no tokens but <|...|> apart."""
    cut, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (
        spec.get("normalizer") is None
        and (cut.get("type"), cut.get("add_prefix_space", True), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        and model.get("type", "BPE") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or [])
    )


class PieceEncoder(PieceStore):
    """A byte-level BPE of the tokenizers library, piece by piece.

    Texts of familiar characters are cut as the library cuts them before merging, and its model merges each new piece
    once. Other texts are cut at white space, and what is new goes through the whole library. So do whole texts where
    the tokenizer isn't one that cuts in this way.
    """

    def __init__(self, path: str, most: int = 300_000):
        super().__init__(most)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            self.plain = _is_plain(json.load(f))
        self.others = False  # whether unfamiliar texts were cut since the last new pieces

    def cut(self, text: str) -> list[str]:
        if not self.plain:
            return [text] if text else []
        if _is_familiar(text):
            return _PRETOKEN.findall(text)
        self.others = True
        return [text] if _UNSURE.search(text) else _PIECE.findall(text)

    def learn(self, fresh: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        flat: list[int] = []
        sizes: list[int] = []
        alone, rest = (fresh, []) if self.plain else ([], fresh)
        if self.others:  # some aren't from familiar texts, and so may be more than the library merges at once
            single = [_is_familiar(p) and _PRETOKEN.fullmatch(p) is not None for p in fresh]
            alone, rest = ([p for p, s in zip(fresh, single, strict=True) if s is kind] for kind in (True, False))
            self.others = False
        if alone:
            for piece in _BETWEEN.join(alone).encode().decode("latin-1").translate(_BYTES).split(_BETWEEN_BYTES):
                tokens = self.model.tokenize(piece)
                flat.extend(map(_ID, tokens))
                sizes.append(len(tokens))
        for at in range(0, len(rest), 5000):
            for e in self.tokenizer.encode_batch_fast(rest[at : at + 5000], add_special_tokens=False):
                flat += e.ids
                sizes.append(len(e.ids))
        return alone + rest, np.array(flat, np.uint32), np.array(sizes, np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder a Python worker; what it has stored serves the worker's next tasks too."""
    return PieceEncoder(path)


def _encode(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        owners: list[int | None] = []
        pending: list[np.ndarray] = []
        size = 0

        def shard() -> pa.RecordBatch:
            lengths = [len(x) for x in pending]
            values = [[part], [seq], [owners], [lengths], [sum(lengths)], [pack(np.concatenate(pending))]]
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "seq", "doc_ids", "lengths", "n_tokens", "codes"])

        for batch in batches:
            for at, end, _, _ in slices(batch.column("text")):
                texts = ["" if t is None else t for t in batch.column("text").slice(at, end - at).to_pylist()]
                for doc_id, ids in zip(batch.column("doc_id").slice(at, end - at).to_pylist(), pieces.encode(texts), strict=True):
                    owners.append(doc_id)
                    pending.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= shard_ids:
                        yield shard()
                        owners, pending, size, seq = [], [], 0, seq + 1
        if owners:
            yield shard()

    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode whole texts in ascending doc_id order (null ids first, ties by text) and write the shards to ``path``.

    Ranges of doc_id, and of the beginnings of texts where many rows bear one id, are the partitions, so parts follow
    one another in order; Spark commits each task's shards once.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encode(tokenizer, end_id, shard_ids), _SHARD).write.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, first): how many ids come before each shard; summed by part first, so no task sees all shards."""
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("own").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("first"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = Codes(batch.column("codes")[i].as_py()).all().astype("<u4")
            lengths = batch.column("lengths")[i].values.to_numpy(zero_copy_only=False)
            stops = np.cumsum(lengths)
            crc = [zlib.crc32(ids[b - n : b]) for b, n in zip(stops.tolist(), lengths.tolist(), strict=True)]
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(c)[i].as_py()] * n, pa.int32()) for c in ("part", "seq")] + [batch.column("doc_ids")[i].values, pa.array(stops - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                names=["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens, ids_crc32, from its decoded ids."""
    shards = spark.read.parquet(path)
    read = shards.select("part", "seq", "doc_ids", "lengths", "codes").mapInArrow(_digest, "part int, seq int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return read.join(shard_starts(shards), ["part", "seq"]).select("doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids array<long>) of every document."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = Codes(batch.column("codes")[i].as_py()).all().astype(np.int64)
                stops = np.concatenate([[0], np.cumsum(batch.column("lengths")[i].values.to_numpy(zero_copy_only=False))])
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values, pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids))], names=["doc_id", "ids"])

    return spark.read.parquet(path).mapInArrow(unpack, "doc_id long, ids array<long>")


def ids_at(spark: SparkSession, path: str, places: DataFrame, together: int = 500_000) -> DataFrame:
    """(doc_id, place, id) for each (doc_id, place) asked for; place counts from 0.

    id is null where the place is null or outside the document, and where there is no such document; a doc_id that
    several documents bear has a row for each. The places asked of a shard meet it once, ``together`` at a time, and of
    its codes only the addressed bytes are read.
    """
    shards = spark.read.parquet(path)
    inner = F.expr("transform(sequence(0, size(lengths) - 1), i -> aggregate(slice(lengths, 1, i), 0L, (a, x) -> a + x))")
    index = shards.select("part", "seq", F.explode(F.arrays_zip("doc_ids", inner.alias("inner"), "lengths")).alias("d"))
    index = index.select("part", "seq", F.col("d.doc_ids").alias("doc_id"), F.col("d.inner").alias("inner"), F.col("d.lengths").alias("length"))
    asked = places.select(F.col("doc_id").cast("long"), F.col("place").cast("long")).join(index, "doc_id", "left")
    inside = F.coalesce((F.col("place") >= 0) & (F.col("place") < F.col("length")), F.lit(False))
    outside = asked.where(~inside).select("doc_id", "place", F.lit(None).cast("long").alias("id"))
    wanted = asked.where(inside).select("part", "seq", "doc_id", "place", (F.col("inner") + F.col("place")).alias("at"))
    turns = wanted.groupBy("part", "seq").agg(F.ceil(F.count("*") / together).cast("int").alias("turns"))
    wanted = wanted.join(turns, ["part", "seq"]).withColumn("turn", F.pmod(F.xxhash64("at"), F.col("turns")).cast("int")).drop("turns")
    codes = shards.select("part", "seq", "codes").join(turns, ["part", "seq"]).select("part", "seq", "codes", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"))

    def fetch(asked: pa.Table, held: pa.Table) -> pa.Table:
        got = []
        if held.num_rows and asked.num_rows:
            codes = Codes(held.column("codes")[0].as_py())
            got = [codes[i] for i in asked.column("at").to_pylist()]
        return pa.table({"doc_id": asked.column("doc_id"), "place": asked.column("place"), "id": pa.array(got, pa.int64())})

    key = ["part", "seq", "turn"]
    wanted, codes = (t.toDF(*t.columns) for t in (wanted, codes))  # columns of their own, though both come from the shards
    return wanted.groupBy(*key).cogroup(codes.groupBy(*key)).applyInArrow(fetch, "doc_id long, place long, id long").unionByName(outside)


def encoded_digests(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` to ``path`` and return the digests read back from there.

    A null text is empty and has only the end id; a null doc_id sorts first; rows that repeat a doc_id are documents
    of their own; an empty table gives no rows; other columns are ignored. A very long text makes one long shard.
    """
    write_token_ids(docs, path, tokenizer, end_id)
    return read_token_digests(docs.sparkSession, path)
