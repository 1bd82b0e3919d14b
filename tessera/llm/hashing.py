"""Vectorised word splitting and hashing over Arrow string buffers.

Texts are handled as the UTF-8 bytes of an Arrow column: white space is ASCII, so words can be cut at bytes.
Everything here is a pure function of numpy arrays, run inside ``mapInArrow`` tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_codes(fold: bool) -> np.ndarray:
    b = np.arange(256, dtype=U64)
    if fold:
        b[65:91] += U64(32)
    with np.errstate(over="ignore"):
        return mix((b + U64(1)) * U64(0xD6E8FEB86659FD93))


_CODES = {True: _byte_codes(True), False: _byte_codes(False)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 19)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def slices(column: pa.Array, most_bytes: int = 500_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most_bytes``: (first row, end row, bytes, offsets).

    A null counts as an empty text; a single longer text makes a run of its own.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of the text that each is in."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of byte spans; with ``fold``, A-Z count as a-z."""
    if not len(starts):
        return np.zeros(0, U64)
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_CODES[fold][data] * power, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


def shingles(words: np.ndarray, text: np.ndarray, n_texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, text after text, and where each text's begin (n_texts + 1 offsets).

    A text with fewer words than ``width`` has its whole sequence as its only shingle; one without words has none.
    """
    factors = mix(np.arange(1, width + 1, dtype=U64) * U64(0xE7037ED1A0B428DB)) | U64(1)
    count = np.bincount(text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(count)])
    if len(words) >= width:
        whole = np.flatnonzero(text[: len(text) - width + 1] == text[width - 1 :])
        total = np.zeros(len(words) - width + 1, U64)
        for k in range(width):
            total += words[k : k + len(total)] * factors[k]
        long_hash, long_text = mix(total[whole] + U64(width)), text[whole]
    else:
        long_hash, long_text = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < width))
    total = count[short].astype(U64)
    for k in range(width - 1):
        has = count[short] > k
        total[has] += words[first[short[has]] + k] * factors[k]
    size = np.zeros(n_texts, np.int64)
    parts = []
    bounds = np.searchsorted(long_text, np.arange(n_texts + 1))
    lone = dict(zip(short.tolist(), mix(total), strict=True))
    for i in range(n_texts):
        got = np.unique(long_hash[bounds[i] : bounds[i + 1]]) if bounds[i + 1] > bounds[i] else np.array([lone[i]], U64) if i in lone else np.zeros(0, U64)
        size[i] = len(got)
        parts.append(got)
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), np.concatenate([[0], np.cumsum(size)])
