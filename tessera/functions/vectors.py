"""Vector functions: cosine as a JVM expression, and a deterministic stand-in for an embedding service."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(1e-12))


def hash_vector(text: str, dim: int) -> np.ndarray:
    """Unit-free numbers in -1..1: a chain of SHA-256 digests, read as big-endian 32-bit integers."""
    out, state = b"", text.encode()
    while len(out) < 4 * dim:
        state = hashlib.sha256(b"e3small" + state).digest()
        out += state
    return np.frombuffer(out[: 4 * dim], ">i4").astype(np.float64) / 2.0**31


def hash_embed(c: Column, dim: int = 64) -> Column:
    """Arrow-batched embedding of texts by hash_vector; null for null."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else hash_vector(t, dim))

    return run(c)
