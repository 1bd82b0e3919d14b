"""Quality classifier: supervised subword embeddings.

Every word and every character 3- and 4-gram (word edges count as a character) is hashed to a row of an embedding
table; a text is the average of its rows, and a softmax layer over it tells good from poor. Table and layer are
learned together by plain numpy stochastic gradient descent on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, with_field
from .hashing import U64, mix, slices, span_hashes, word_spans
from .labelled import labelled_sample

BITS, DIMENSIONS, GRAMS = 17, 8, (3, 4)
#: The training sample's bound by label; epochs (more where they make fewer steps than that) and first learning rate.
SAMPLE, EPOCHS, STEPS, RATE = {0: 3000, 1: 6000}, 6, 15_000, 0.1
HELD_OUT = 1
_SHIFT = U64(64 - BITS)
_END = 0  # row of the end mark that every text has, so an empty text has a vector too


def _char_codes() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1 << 16, dtype=U64) + U64(3)) * U64(0x9E3779B97F4A7C15))


_CHARS = _char_codes()
_FACTORS = mix(np.arange(1, 9, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Families of features: (table rows, number of the text of each), texts in order."""
    starts, ends, text = word_spans(data, offsets)
    yield (span_hashes(data, starts, ends, fold=False) >> _SHIFT).astype(np.int64), text
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = lead[offsets]
    space = (points == 32) | ((points >= 9) & (points <= 13))
    codes = _CHARS[np.where(space, 32, points & 0xFFFF)]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    for n in GRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        total = np.full(m, U64(n) * U64(0x2545F4914F6CDD1D), U64)
        whole = owner[:m] == owner[n - 1 :]
        for k in range(n):
            total += codes[k : k + m] * _FACTORS[k]
            if 0 < k < n - 1:
                whole &= ~space[k : k + m]
        yield (total[whole] >> _SHIFT).astype(np.int64), owner[:m][whole]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, text) to (y, distinct rows as int32, their shares of the text as float32)."""
    with np.errstate(over="ignore"):
        for batch in batches:
            labels = batch.column("y").to_numpy(zero_copy_only=False)
            for at, end, data, offsets in slices(batch.column("text"), 500_000):
                n = end - at
                found = [rows + text * (1 << BITS) for rows, text in features(data, offsets)] + [np.arange(n) * (1 << BITS) + _END]
                cells, counts = np.unique(np.concatenate(found), return_counts=True)
                cut = np.searchsorted(cells, np.arange(n + 1) * (1 << BITS))
                rows, shares = [], []
                for i in range(n):
                    c = counts[cut[i] : cut[i + 1]]
                    rows.append((cells[cut[i] : cut[i + 1]] & ((1 << BITS) - 1)).astype(np.int32).tobytes())
                    shares.append((c / c.sum()).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(labels[at:end].astype(np.int32)), pa.array(rows, pa.binary()), pa.array(shares, pa.binary())], names=["y", "rows", "shares"])


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """What each table row adds to the log odds of label 1 (float32), after softmax training on averaged rows."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), np.float32)
    epochs = max(epochs, -(-STEPS // max(1, len(bags))))
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            y, rows, shares = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            own = table[rows]
            # plain sums: a matrix product may round otherwise for other places in memory, and reruns must agree
            hidden = np.add.reduce(shares[:, None] * own, axis=0)
            logits = np.add.reduce(layer * hidden, axis=1)
            odds = np.exp(logits - logits.max())
            slope = odds / odds.sum()
            slope[y] -= 1
            pull = slope[0] * layer[0] + slope[1] * layer[1]
            layer -= step * np.outer(slope, hidden)
            # the full mean gradient is tiny for long texts; as is usual for such models every row gets it whole
            table[rows] = own - step * (shares * len(rows))[:, None].clip(max=4.0) * pull
    return np.add.reduce(table * (layer[1] - layer[0]), axis=1).astype(np.float32)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = []
    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("rows", "shares", "y")), strict=True)
    if len({y for *_, y in held}) == 2:
        held.sort()  # partitions come in any order; the result doesn't depend on it
        bags = [(y, np.frombuffer(rows, np.int32), np.frombuffer(shares, np.float32)) for rows, shares, y in held]
        yield pa.RecordBatch.from_arrays([pa.array([train(bags).tobytes()], pa.binary())], names=["odds"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> np.ndarray:
    """Per-row log odds, learned from at most ``sample`` labelled documents a label in one task, outside the held-out fold.

    Without labelled documents of both kinds all odds are even.
    """
    chosen = labelled_sample(docs, labels, "quality", sample or SAMPLE, HELD_OUT)
    bags = chosen.select("y", "text").mapInArrow(_bags, "y int, rows binary, shares binary")
    model = bags.repartition(1).mapInArrow(_fit, "odds binary").collect()
    return np.frombuffer(bytes(model[0]["odds"]), np.float32) if model else np.zeros(1 << BITS, np.float32)


def _score(odds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at, end, data, offsets in slices(batch.column("text")):
                    n = end - at
                    total, count = np.full(n, float(odds[_END])), np.ones(n)
                    for rows, text in features(data, offsets):
                        total += np.bincount(text, odds[rows], n)
                        count += np.bincount(text, minlength=n)
                    score = 1 / (1 + np.exp(-np.clip(total / count, -30, 30)))
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, n) for i in range(batch.num_columns)), pa.array(score)], names=[*batch.schema.names, "score"])

    return run


def with_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with ``score`` added (a column of that name is replaced): the chance of label 1 by the whole text alone.

    Null and empty texts have only the end mark. Rows, repeated ones too, stay as they are; an empty table stays empty.
    """
    score = _score(fit_quality(docs, labels))
    kept = docs.drop("score")
    schema = with_field(kept, "score", "double")
    return kept.mapInArrow(score, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 where score >= threshold).

    Null and empty texts are scored by their end mark; a null doc_id is kept with a null held_out; repeated rows are
    scored each; an empty table gives no rows; other columns are never read.
    """
    scored = with_quality(docs.select("doc_id", "text"), labels)
    held = fold_of(F.col("doc_id"), 3) == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
