"""Whitening of embeddings from an exact covariance: digit slices through float64 products, recombined as big integers.

Components become whole numbers x = floor(256 * c). The centred rows y = n * x - S are whole as well; they are split
into limbs of LIMB bits, and the products of limb matrices are exact in float64, as a block has few enough rows. A task
recombines its products as big integers and writes them in digits of 32 bits, which Spark adds up; the sums are whole
whatever the order. The covariance so found is rounded once, and decomposed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

SCALE, COMPONENTS = 256, 4
#: Bits of a limb; BLOCK rows of products of two limbs stay below 2 ** 53.
LIMB, BLOCK = 16, 1 << 20
#: Products are added up as 64-bit integers for so many blocks before they become big integers.
BLOCKS = 512
#: Digits of 32 bits that sums and products are written in.
SUM_DIGITS, PRODUCT_DIGITS = 4, 8
#: Components with a smaller share of the variance than this have none that doubles can tell from zero.
NOTHING = 1e-13
_GOOD = "embedding is not null and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('inf') and abs(c) <= 3e16)"


def whole_matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Cells of ``dim`` 64-bit integers as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, as 64-bit integers where these hold them, else as big integers."""
    most = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums), default=0)
    kind = np.int64 if most < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as float64 limbs of LIMB bits, lowest first; all but the last are not negative."""
    out = []
    while True:
        if y.size == 0 or max(abs(int(y.min())), abs(int(y.max()))) < 1 << LIMB:
            return [*out, y.astype(np.float64)]
        out.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB


class Gram:
    """Exact sum of y.T @ y over blocks of rows."""

    def __init__(self, dim: int):
        self.total = np.zeros((dim, dim), object)
        self.sums: dict[int, np.ndarray] = {}
        self.blocks = 0

    def add(self, y: np.ndarray) -> None:
        for at in range(0, len(y), BLOCK):
            parts = limbs(y[at : at + BLOCK])
            for i, a in enumerate(parts):
                for j in range(i, len(parts)):
                    p = (a.T @ parts[j]).astype(np.int64)
                    p = p if i == j else p + p.T
                    self.sums[i + j] = self.sums[i + j] + p if i + j in self.sums else p
            self.blocks += 1
            if self.blocks >= BLOCKS // max(1, len(parts)):
                self._recombine()

    def _recombine(self) -> None:
        for k, p in self.sums.items():
            self.total = self.total + p.astype(object) * (1 << LIMB * k)
        self.sums, self.blocks = {}, 0

    def value(self) -> np.ndarray:
        self._recombine()
        return self.total


def digits(values: list[int], count: int) -> list[list[int]]:
    """Two's-complement digits of 32 bits, lowest first; the last has the sign."""
    low = (1 << 32) - 1
    return [[(v >> 32 * k) & low if k < count - 1 else v >> 32 * k for v in values] for k in range(count)]


def from_digits(columns: list[list[int]]) -> list[int]:
    """Sums of digits as big integers."""
    return [sum(int(d) << 32 * k for k, d in enumerate(row)) for row in zip(*columns, strict=True)]


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, its rows, their x) of a batch."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, whole_matrix(batch.column("x").take(pa.array(rows)), dim)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, x): components as whole numbers, packed."""
    for batch in batches:
        lists = batch.column("embedding")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        size = np.diff(lists.offsets.to_numpy())
        x = np.floor(SCALE * flat).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        cells = [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(size, pa.int32()), pa.array(cells, pa.binary())], names=["vec_id", "dim", "x"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, i, n, digits of the sum) of a task's rows."""
    total: dict[int, list] = {}
    for batch in batches:
        for dim, rows, x in _by_dim(batch):
            n, own = total.get(dim, (0, np.zeros(dim, object)))
            # halves, so that no sum of a batch overflows
            total[dim] = (n + len(rows), own + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object))
    for dim, (n, own) in total.items():
        columns = [pa.array(d, pa.int64()) for d in digits(own.tolist(), SUM_DIGITS)]
        yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), *columns], names=["dim", "i", "n", *_names(SUM_DIGITS)])


def _names(count: int) -> list[str]:
    return [f"d{k}" for k in range(count)]


def _products(fits: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(dim, i, j, digits of the product) of a task's rows, for i <= j."""
        grams: dict[int, Gram] = {}
        for batch in batches:
            for dim, _, x in _by_dim(batch):
                n, sums = fits[dim]
                grams.setdefault(dim, Gram(dim)).add(centred(x, n, sums))
        for dim, gram in grams.items():
            i, j = np.triu_indices(dim)
            values = gram.value()[i, j]
            for at in range(0, len(i), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [pa.array(d, pa.int64()) for d in digits(values[part].tolist(), PRODUCT_DIGITS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i[part]), dim), pa.int32()), pa.array(i[part], pa.int32()), pa.array(j[part], pa.int32()), *columns], names=["dim", "i", "j", *_names(PRODUCT_DIGITS)])

    return run


def components(products: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(largest eigenvalues falling, their unit eigenvectors as rows, trace) of the covariance products / n ** 3."""
    dim = len(products)
    v = np.array([[int(p) / n**3 for p in row] for row in products], np.float64).reshape(dim, dim)
    values, vectors = np.linalg.eigh(v)
    top = np.argsort(-values, kind="stable")[:COMPONENTS]
    return values[top], vectors[:, top].T, float(np.trace(v))


def _decompose(fits: dict):
    def run(table: pa.Table) -> pa.Table:
        """A length's model from its products: bounded by the length, whatever the number of vectors."""
        dim = table.column("dim")[0].as_py()
        products = np.zeros((dim, dim), object)
        i, j = (table.column(c).to_numpy() for c in "ij")
        products[i, j] = products[j, i] = from_digits([table.column(c).to_pylist() for c in _names(PRODUCT_DIGITS)])
        values, vectors, trace = components(products, fits[dim][0])
        return pa.table({"dim": pa.array([dim], pa.int32()), "values": [values.tolist()], "vectors": [vectors.ravel().tolist()], "trace": [trace]})

    return run


def _projected(x: np.ndarray, fit: tuple, model: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(y, whitened [rows, components]); components without variance are NaN."""
    (n, sums), (values, vectors, trace) = fit, model
    y = centred(x, n, sums)
    scale = np.array([1 / np.sqrt(e) if e > NOTHING * trace else np.nan for e in values])
    return y, ((y / n).astype(np.float64) @ vectors.T) * scale


def _whiten(fits: dict, models: dict):
    """(…, component, n, deviation, whitened, explained) for each row and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in _by_dim(batch):
                values, _, trace = models[dim]
                y, w = _projected(x, fits[dim], models[dim])
                most = max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0))))
                if dim * most * most < 1 << 63:
                    deviation = pa.array(np.einsum("id,id->i", y, y), pa.int64())
                else:
                    exact = ((y.astype(object) ** 2).sum(axis=1)).tolist()
                    deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
                k = len(values)
                share = [e / trace if trace > 0 else 0.0 for e in values]
                take = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)).take(take),
                        pa.array(np.full(len(take), dim), pa.int32()),
                        pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                        pa.array(np.full(len(take), fits[dim][0]), pa.int64()),
                        deviation.take(take),
                        pa.array(w.ravel(), pa.float64(), from_pandas=True),
                        pa.array(np.tile(share, len(rows)), pa.float64()),
                    ],
                    names=["vec_id", "dim", "component", "n", "deviation", "whitened", "explained"],
                )

    return run


def _fit_scores(fits: dict, models: dict):
    """(dim, w1 to w4) of the fit list; null where there is no such component, or it has no variance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in _by_dim(batch):
                w = np.full((len(rows), COMPONENTS), np.nan)
                own = _projected(x, fits[dim], models[dim])[1]
                w[:, : own.shape[1]] = own
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), dim), pa.int32()), *(pa.array(c, pa.float64(), from_pandas=True) for c in w.T)], names=["dim", *(f"w{k}" for k in range(COMPONENTS))])

    return run


def whitened_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per vector and leading component.

    Components become x = floor(SCALE * c); each distinct x counts once in the fit, n of them with sums S. The
    covariance of x is exact until it is rounded to doubles. deviation is the sum of (n * x - S) ** 2, whole; whitened is
    x - S / n along the unit eigenvector, over the root of its eigenvalue; explained is the eigenvalue's share of the
    trace; identity_error is the largest difference between the covariance of the fit's whitened values and the
    identity, measured from these values by Spark's centred sums.

    Vectors that are null, or have a null or non-finite component, or one beyond 3e16 (which doubles floor to
    no 64-bit integer), are dropped. Each length of vectors is a fit of its own; shorter ones than COMPONENTS have
    as many components as they are long, empty ones none. A component without variance (fewer distinct vectors than
    components, equal rows only) has a null whitened and takes no part in identity_error, which is null if none does. A
    deviation beyond 64 bits is null. Rows that repeat, ids that repeat and null ids each have their own rows; an
    empty table gives none; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding")).where(_GOOD).where(F.size("embedding") > 0)
    kind = rows.schema["vec_id"].dataType.simpleString()
    whole = saved(rows.mapInArrow(_whole, f"vec_id {kind}, dim int, x binary"), "whole-vectors")
    fit = saved(whole.select("dim", "x").distinct(), "fit-list")

    def total(count: int) -> list:
        return [F.sum(c).alias(c) for c in _names(count)]

    schema = "dim int, i int, n long, " + ", ".join(f"{c} long" for c in _names(SUM_DIGITS))
    sums = fit.mapInArrow(_sums, schema).groupBy("dim", "i").agg(F.sum("n").alias("n"), *total(SUM_DIGITS)).orderBy("dim", "i").collect()  # a row a dimension
    fits: dict[int, tuple[int, list[int]]] = {}
    for r in sums:
        fits.setdefault(r["dim"], (r["n"], []))[1].append(sum(r[c] << 32 * k for k, c in enumerate(_names(SUM_DIGITS))))

    schema = "dim int, i int, j int, " + ", ".join(f"{c} long" for c in _names(PRODUCT_DIGITS))
    products = fit.mapInArrow(_products(fits), schema).groupBy("dim", "i", "j").agg(*total(PRODUCT_DIGITS))
    found = products.groupBy("dim").applyInArrow(_decompose(fits), "dim int, values array<double>, vectors array<double>, trace double").collect()  # a row a length
    models = {r["dim"]: (np.array(r["values"]), np.array(r["vectors"]).reshape(len(r["values"]), r["dim"]), r["trace"]) for r in found}

    scores = fit.mapInArrow(_fit_scores(fits, models), "dim int, " + ", ".join(f"w{k} double" for k in range(COMPONENTS)))
    gaps = [F.abs(F.covar_pop(f"w{a}", f"w{b}") - (1.0 if a == b else 0.0)) for a in range(COMPONENTS) for b in range(a, COMPONENTS)]
    errors = scores.groupBy("dim").agg(F.greatest(*gaps).alias("identity_error"))
    out = whole.mapInArrow(_whiten(fits, models), f"vec_id {kind}, dim int, component int, n long, deviation long, whitened double, explained double")
    return out.join(F.broadcast(errors), "dim", "left").drop("dim")  # a row a length
