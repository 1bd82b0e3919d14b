"""A stored approximate index of vectors: inverted lists of cells with product-quantised codes, re-ranked exactly."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.writers import stored
from .retrieval import cosine_topk

_USABLE = "id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)"


def _means(x: np.ndarray, k: int, steps: int = 10) -> np.ndarray:
    """k-means from k spread rows; an empty cluster keeps its centre."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(steps):
        own = _closest(x, c)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
    return c.astype(np.float32)


def _closest(x: np.ndarray, c: np.ndarray, many: int = 1) -> np.ndarray:
    """The nearest centre of each row; the ``many`` nearest, nearest first, if more are asked."""
    out = np.zeros((len(x), many), np.int64)
    for at in range(0, len(x), 4096):
        away = (c * c).sum(axis=1) - 2 * x[at : at + 4096] @ c.T
        out[at : at + 4096] = np.argsort(away, axis=1, kind="stable")[:, :many] if many > 1 else away.argmin(axis=1)[:, None]
    return out if many > 1 else out[:, 0]


def _units(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column's rows as unit vectors."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Quantizer:
    """Cells, and within a cell one of 256 centres for each stretch of the rest of a vector."""

    def __init__(self, cells: np.ndarray, books: list[np.ndarray]):
        self.cells, self.books = cells, books
        self.cuts = np.cumsum([0, *(b.shape[1] for b in books)])

    @classmethod
    def trained(cls, x: np.ndarray, cells: int, stretches: int) -> Quantizer:
        c = _means(x, min(cells, len(x)))
        rest = (x - c[_closest(x, c)]).astype(np.float32)
        parts = np.array_split(np.arange(x.shape[1]), min(stretches, x.shape[1]))
        return cls(c, [_means(rest[:, p], min(256, len(x))) for p in parts])

    def codes(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = x - self.cells[cell]
        return np.stack([_closest(rest[:, a:b], book) for a, b, book in zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)], axis=1).astype(np.uint8)

    def closeness(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """About the cosine of queries [queries] with a cell's codes [rows]: a table look-up for each stretch."""
        out = np.repeat((q @ self.cells[cell])[:, None], len(codes), axis=1)
        for j, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books, strict=True)):
            out += (q[:, a:b] @ book.T)[:, codes[:, j]]
        return out


class VectorIndex:
    """Vectors of one length under ``path``, searched by cosine. Of queries that repeat an id the smallest vector asks.

    ``model`` holds the quantizer, made once from a bounded sample. ``codes`` and ``vectors`` lie by batch and group of
    cells, sorted by cell: a search reads the codes of the cells that it probes, and the vectors of what they bring up.
    A table of ids is written last; a batch that it doesn't name doesn't count, so one that failed midway is invisible
    and its rows come again.
    """

    #: Rows a cell is meant to have, cells that share a folder, stretches of a code, the sample's bound in rows and bytes.
    CELL, GROUP, STRETCHES, SAMPLE, SAMPLE_BYTES = 1000, 16, 16, 65_536, 1 << 26
    #: Codes kept a query for each row asked, before the exact ranking.
    KEEP = 8
    #: Rows of a group, and queries, that meet in one task.
    SLICE, TURN = 16_384, 1024

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _usable(self, df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(_USABLE)

    def build(self, df: DataFrame, id_col: str, vector_col: str, cells: int | None = None) -> VectorIndex:
        """Learns cells and codes from a sample of the most frequent length, and stores df's rows."""
        rows = self._usable(df, id_col, vector_col)
        most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        if most is None:
            raise ValueError("there is no usable vector to learn from")
        dim = most["dim"]
        bound = max(1, min(self.SAMPLE, self.SAMPLE_BYTES // (8 * dim)))
        drawn = rows.where(F.size("v") == dim).orderBy(F.xxhash64("id"), "id").limit(bound).select("v").toArrow()  # bounded
        count = cells or max(8, min(4096, round(most["count"] / self.CELL), bound // 16 or 1))
        q = Quantizer.trained(_units(drawn.column("v"), dim).astype(np.float32), count, self.STRETCHES)
        row = (dim, len(q.cells), q.cells.tobytes(), [b.tobytes() for b in q.books], [int(b.shape[1]) for b in q.books])
        self.spark.createDataFrame([row], "dim int, n int, cells binary, books array<binary>, widths array<int>").coalesce(1).write.parquet(f"{self.path}/model")
        self.refresh(df, id_col, vector_col)
        return self

    def quantizer(self) -> tuple[int, Quantizer]:
        r = self.spark.read.parquet(f"{self.path}/model").first()
        books = [np.frombuffer(b, np.float32).reshape(-1, w) for b, w in zip(r["books"], r["widths"], strict=True)]
        return r["dim"], Quantizer(np.frombuffer(r["cells"], np.float32).reshape(r["n"], -1), books)

    def ids(self) -> DataFrame:
        try:
            return self.spark.read.schema("id long, batch string").parquet(f"{self.path}/ids")
        except AnalysisException:  # nothing stored yet
            return self.spark.createDataFrame([], "id long, batch string")

    def refresh(self, df: DataFrame, id_col: str, vector_col: str) -> None:
        """Stores the rows whose id isn't there yet; of rows that repeat an id the smallest vector. Other lengths are left out."""
        dim, q = self.quantizer()
        batch = uuid.uuid4().hex
        rows = self._usable(df, id_col, vector_col).where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
        rows = rows.join(self.ids().select("id"), "id", "left_anti")

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _units(b.column("v"), dim).astype(np.float32)
                cell = _closest(x, q.cells)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in q.codes(x, cell)], pa.binary())], names=["id", "v", "cell", "code"])

        made = rows.mapInArrow(coded, "id long, v array<double>, cell int, code binary").withColumn("part", F.floor(F.col("cell") / self.GROUP).cast("int"))
        # a group of cells goes to some tasks, each of which writes one file; the salt splits one that holds most rows
        dealt = made.repartition("part", F.pmod(F.xxhash64("id"), F.lit(4))).sortWithinPartitions("part", "cell")
        dealt.write.partitionBy("part").parquet(f"{self.path}/lists/batch={batch}")
        self._lists([batch]).select("id", F.lit(batch).alias("batch")).write.mode("append").parquet(f"{self.path}/ids")

    def _lists(self, batches: list[str] | None = None) -> DataFrame | None:
        names = batches if batches is not None else [r[0] for r in self.ids().select("batch").distinct().collect()]  # one a refresh
        if not names:
            return None
        schema = "id long, v array<double>, cell int, code binary, batch string, part int"
        return self.spark.read.option("basePath", f"{self.path}/lists").schema(schema).parquet(*[f"{self.path}/lists/batch={b}" for b in names])

    def search(self, queries: DataFrame, id_col: str, vector_col: str, k: int, probes: int, keep: int | None = None) -> DataFrame:
        """(query_id, id, score, rank): of the rows in the ``probes`` cells nearest to a query the ``keep`` that their codes
        place first (KEEP * k without), ranked exactly, best ``k``. A query isn't its own result; ties by id. With every
        cell and ``keep`` as many as all rows it is exact."""
        dim, q = self.quantizer()
        keep = keep or self.KEEP * k
        lists = self._lists()
        if lists is None:
            return self.spark.createDataFrame([], "query_id long, id long, score double, rank int")
        many, size = min(probes, len(q.cells)), self.GROUP

        def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _units(b.column("v"), dim)
                near = _closest(x.astype(np.float32), q.cells, max(2, many))[:, :many]
                take, parts, cells = [], [], []
                for i, own in enumerate(near):
                    group = own // size
                    for g in np.unique(group).tolist():
                        take.append(i)
                        parts.append(g)
                        cells.append(own[group == g].tolist())
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(take, pa.int64())), b.column("v").take(pa.array(take, pa.int64())), pa.array(parts, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], names=["id", "v", "part", "cells"])

        asked = self._usable(queries, id_col, vector_col).where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
        asks = asked.mapInArrow(routed, "id long, v array<double>, part int, cells array<int>")
        # a group's rows are cut to slices, and queries to turns: a task holds a slice and a turn
        sizes = lists.groupBy("part").agg(F.ceil(F.count("*") / self.SLICE).alias("slices"))
        turns = asked.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / self.TURN)).alias("turns"))  # one row
        # where every row is kept there is nothing for codes to choose, and slices rank their vectors exactly
        exact = many == len(q.cells) and keep >= self.ids().count()
        held = F.col("v") if exact else F.lit(None).cast("array<double>")
        one = asks.join(sizes, "part").join(F.broadcast(turns)).withColumn("turn", F.pmod(F.xxhash64("id"), F.col("turns")))
        one = one.select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "turn", "id", "v", "cells", F.lit(None).cast("binary").alias("code"))
        codes = lists.select("part", "id", held.alias("v"), "cell", "code").join(sizes, "part").join(F.broadcast(turns))
        two = codes.select("part", F.pmod(F.xxhash64("id"), F.col("slices")).alias("slice"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"), "id", "v", F.array("cell").alias("cells"), "code")
        tasks = one.unionByName(two).groupBy("part", "slice", "turn")
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        if exact:
            scored = tasks.applyInArrow(_nearest(dim, k), "query_id long, id long, score double")
            return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "id", "score", "rank")
        brought = tasks.applyInArrow(_candidates(q, dim, keep), "query_id long, id long, part int, near double")
        brought = brought.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "id"))).where(F.col("n") <= keep)
        asked = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
        met = brought.select("query_id", "id", "part").join(lists.select("id", "part", "v"), ["part", "id"]).join(asked, "query_id")
        dot = "aggregate(zip_with(q, v, (x, y) -> x * y), 0d, (s, x) -> s + x)"
        length = "(sqrt(aggregate({0}, 0d, (s, x) -> s + x * x)))"
        scored = met.select("query_id", "id", F.expr(f"{dot} / ({length.format('q')} * {length.format('v')} + 1e-12)").alias("score"))
        return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "id", "score", "rank")


def _rows_of(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, added up one component after another, so equal rows have equal sums wherever they stand."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def _nearest(dim: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        """A slice's vectors and a turn of queries to the ``k`` rows that are nearest to each query there, by exact cosine."""
        is_row = table.column("code").is_valid().to_numpy()
        base, asks = (table.take(pa.array(np.flatnonzero(m))) for m in (is_row, ~is_row))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if base.num_rows and asks.num_rows:
            x, y = _rows_of(base.column("v"), dim), _rows_of(asks.column("v"), dim)
            ids, q_ids = base.column("id").to_numpy(), asks.column("id").to_numpy()
            size, q_size = np.sqrt(_sums(x, x)), np.sqrt(_sums(y, y))
            units = x / (size[:, None] + 1e-300)
            for at in range(0, len(y), 64):
                near = (y[at : at + 64] / q_size[at : at + 64, None]) @ units.T
                near[q_ids[at : at + 64, None] == ids] = -np.inf
                # products of matrices round by place: what may be among the k is scored anew
                bar = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] - 1e-9 if k < len(ids) else np.full(len(near), -2.0)
                for i in range(len(near)):
                    may = np.flatnonzero((near[i] >= bar[i]) & (near[i] > -np.inf))
                    score = np.zeros(len(may))
                    for b in range(0, len(may), 4096):
                        own = may[b : b + 4096]
                        score[b : b + 4096] = _sums(np.broadcast_to(y[at + i], (len(own), dim)), x[own]) / (q_size[at + i] * size[own] + 1e-12)
                    best = np.lexsort((ids[may], -score))[:k]
                    out.append((np.full(len(best), q_ids[at + i]), ids[may[best]], score[best]))
        found = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.table(dict(zip(("query_id", "id", "score"), found, strict=True)))

    return run


def _candidates(q: Quantizer, dim: int, keep: int):
    def run(table: pa.Table) -> pa.Table:
        """A slice of a group of cells and its queries to the rows that the codes place first for each query."""
        is_code = table.column("code").is_valid().to_numpy()
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        part = table.column("part")[0].as_py()
        base, asks = (table.take(pa.array(np.flatnonzero(m))) for m in (is_code, ~is_code))
        if base.num_rows and asks.num_rows:
            x, q_ids, ids = _units(asks.column("v"), dim).astype(np.float32), asks.column("id").to_numpy(), base.column("id").to_numpy()
            cell = base.column("cells").combine_chunks().flatten().to_numpy()
            codes = np.frombuffer(b"".join(base.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            lists = asks.column("cells").combine_chunks()
            wanted, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(q_ids)), np.diff(lists.offsets.to_numpy()))
            for c in np.unique(wanted).tolist():
                own, rows = np.flatnonzero(cell == c), row[wanted == c]
                for at in range(0, len(rows) if len(own) else 0, 256):
                    near = q.closeness(x[rows[at : at + 256]], c, codes[own])
                    near[q_ids[rows[at : at + 256], None] == ids[own]] = -np.inf
                    best = np.argpartition(-near, keep - 1, axis=1)[:, :keep] if keep < len(own) else np.broadcast_to(np.arange(len(own)), near.shape)
                    score = np.take_along_axis(near, best, axis=1)
                    real = score > -np.inf
                    out.append((np.repeat(rows[at : at + 256], real.sum(axis=1)), own[best[real]], score[real]))
            r, i, score = (np.concatenate(c) for c in zip(*out, strict=True))
            order = np.lexsort([ids[i], -score, r])
            order = order[np.arange(len(order)) - np.searchsorted(r[order], r[order], "left") < keep]
            out = [(q_ids[r[order]], ids[i[order]], score[order])]
        found = out[0]
        return pa.table({"query_id": found[0], "id": found[1], "part": pa.array(np.full(len(found[0]), part), pa.int32()), "near": found[2]})

    return run


def searched_with_recall(index: VectorIndex, vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int, least: float = 0.9) -> DataFrame:
    """index.search with ``recall`` and ``probes``: what the result has of the true ``k`` nearest rows, found by comparing
    the queries with all vectors in blocks. Twice as many cells and codes are searched until it is ``least`` or more,
    in the end all cells and rows, which is exact. No queries: a null recall."""
    dim, q = index.quantizer()
    cells = len(q.cells)
    sides = [index._usable(t, id_col, vector_col).where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v")) for t in (vectors, queries)]
    truth = stored(cosine_topk(*sides, "id", "v", k).select("query_id", "id"), "true-nearest")
    total = truth.count()
    probes, keep = max(1, cells // 4), index.KEEP * k
    while True:
        whole = probes >= cells
        found = stored(index.search(queries, id_col, vector_col, k, probes, keep), "found")
        hits = found.join(truth, ["query_id", "id"], "left_semi").count()
        recall = hits / total if total else None
        if recall is None or recall >= least or whole:
            return found.withColumns({"recall": F.lit(recall).cast("double"), "probes": F.lit(min(probes, cells))})
        probes, keep = 2 * probes, 2 * keep
