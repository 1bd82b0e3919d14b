"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into balanced parts that break few of its edges, and a small classifier
learns which part a vector's neighbours are in. It assigns every row to its most probable part and routes a query to
several. How many is read off an audit: for some queries the true neighbours are found by brute force, and so many
parts are searched that the share of them that routing reaches is what is asked. Everything in the parts searched is
compared with the query in double precision.

Nearness is the largest inner product. For the graph and the classifier a row becomes (x, sqrt(M ** 2 - |x| ** 2)) / M
with M the largest length, and a query (q, 0) / |q|, so the largest inner product is the smallest angle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Rows a part is meant to have, and the fewest and most parts.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 800, 8, 1024
#: Sampled rows a part, and bytes of the sample's vectors as 32-bit floats.
SAMPLE_ROWS, SAMPLE_BYTES = 128, 1 << 26
#: Neighbours in the graph; hidden units, passes and rate of the classifier.
DEGREE, HIDDEN, EPOCHS, RATE = 10, 128, 30, 0.003
#: Products that are held at once while the graph is made, and bytes of queries that are sent to their parts at once.
GRAPH_CELLS, ASKED_BYTES = 1 << 22, 1 << 25
#: Queries that are audited, and the share of their true neighbours that routing must reach.
AUDITED, RECALL = 1024, 0.93
#: Lengths of vectors that have a model; rows of other lengths are one part a length, which is searched whole.
MODELS = 16
#: A part is searched in pages of so many rows and bytes, by blocks of so many queries.
PAGE, PAGE_BYTES, QUERIES = 8192, 1 << 24, 4096
_GOOD = "embedding is not null and size(embedding) > 0 and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('inf')) and exists(embedding, c -> c <> 0)"


# ---------------------------------------------------------------- the graph, its parts and the classifier


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Rows as unit vectors with one component more, so that angles rank as inner products do."""
    x = x / most
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("id,id->i", x, x)))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def asked(q: np.ndarray) -> np.ndarray:
    q = q / np.abs(q).max(axis=1, keepdims=True)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    return np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)


def neighbours(x: np.ndarray, all_x: np.ndarray, own: np.ndarray, k: int = DEGREE) -> np.ndarray:
    """Places in all_x of the k nearest of each row of x, but for its own place."""
    k = min(k, len(all_x) - 1)
    out = np.zeros((len(x), max(0, k)), np.int64)
    step = max(16, min(512, GRAPH_CELLS // len(all_x)))
    for at in range(0, len(x) if k > 0 else 0, step):
        near = x[at : at + step] @ all_x.T
        near[np.arange(len(near)), own[at : at + step]] = -np.inf
        out[at : at + step] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """The part of each node: ``parts`` (a power of two) of equal size, by halving again and again.

    Each step takes the slowest-mixing vector of the graph inside every part (power iteration on its random walk, all
    parts together), cuts at its median, and exchanges pairs between the halves while that saves edges.
    """
    n, k = graph.shape
    a = np.concatenate([np.repeat(np.arange(n), k), graph.ravel()])
    b = np.concatenate([graph.ravel(), np.repeat(np.arange(n), k)])
    part = np.zeros(n, np.int64)
    start = np.random.default_rng(7).normal(size=n)
    count = 1
    while count < parts:
        inside = part[a] == part[b]
        u, v = a[inside], b[inside]
        degree = np.bincount(u, minlength=n) + 1.0
        weight = np.bincount(part, degree, count)
        f = start.copy()
        for _ in range(60):
            f = 0.5 * f + 0.5 * (np.bincount(u, f[v], n) + f) / degree
            f -= (np.bincount(part, f * degree, count) / np.maximum(weight, 1e-12))[part]
            f /= np.sqrt(np.maximum(np.bincount(part, f * f * degree, count), 1e-30))[part]
        order = np.lexsort([f, part])
        size = np.bincount(part, minlength=count)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        high = rank >= (size[part] + 1) // 2
        for _ in range(10):
            # what moving a node to the other half saves: its edges there less those here
            across = np.where(high[u] != high[v], 1.0, -1.0)
            gain = np.bincount(u, across, n)
            order = np.lexsort([-gain, high, part])
            low_n = np.bincount(part, ~high, count).astype(int)
            first = np.cumsum(size) - size
            moved = 0
            for p in range(count):
                low, up = order[first[p] : first[p] + low_n[p]], order[first[p] + low_n[p] : first[p] + size[p]]
                m = min(len(low), len(up))
                good = int(np.count_nonzero(gain[low[:m]] + gain[up[:m]] > 0))
                take = (good + 3) // 4  # neighbours moving together would undo each other's gain
                high[low[:take]], high[up[:take]] = True, False
                moved += take
            if not moved:
                break
        part = 2 * part + high
        count *= 2
    return part


class Router:
    """Softmax over parts from one hidden layer; trained on the share of a row's neighbours in each part."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    @classmethod
    def trained(cls, x: np.ndarray, near: np.ndarray, parts: int) -> Router:
        """From rows and the parts of their neighbours [rows, neighbours]."""
        rnd = np.random.default_rng(11)
        weights = [rnd.normal(0, 1, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rnd.normal(0, HIDDEN**-0.5, (HIDDEN, parts)), np.zeros(parts)]
        weights = [w.astype(np.float32) for w in weights]
        first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS))
            order = rnd.permutation(len(x))
            for at in range(0, len(x), 256):
                rows = order[at : at + 256]
                w1, b1, w2, b2 = weights
                hidden = np.maximum(x[rows] @ w1 + b1, 0)
                logits = hidden @ w2 + b2
                p = np.exp(logits - logits.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                for c in range(near.shape[1]):
                    p[np.arange(len(rows)), near[rows, c]] -= 1.0 / near.shape[1]
                p /= len(rows)
                back = (p @ w2.T) * (hidden > 0)
                step += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), hidden.T @ p, p.sum(axis=0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return cls([w.astype(np.float32) for w in weights])


# ---------------------------------------------------------------- exact comparison


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added up from the first component to the last, so equal rows have equal sums."""
    out = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(a.shape[1]):
            out += a[:, d] * b[:, d]
    return out


def nearest(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place in x, score) of each query's k nearest rows with another id; ties go to the smaller id.

    Products of matrices say which rows may be among them, with room for rounding; those are computed again in a fixed order.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    # whatever a sum's order is, its rounding is below this share of the product of lengths
    slack = 4 * x.shape[1] * np.finfo(float).eps
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.linalg.norm(x, axis=1).max(initial=0)
        room = slack * length * np.linalg.norm(q, axis=1)
        for at in range(0, len(q), 256):
            near = q[at : at + 256] @ x.T
            near[q_ids[at : at + 256, None] == ids] = -np.inf
            near[np.isnan(near)] = np.inf  # overflowed both ways: decided by the sum in order
            edge = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] if k < len(ids) else np.full(len(near), -np.inf)
            bar = edge - room[at : at + 256]
            bar[np.isnan(bar)] = -np.inf
            r, c = np.nonzero((near >= bar[:, None]) & (q_ids[at : at + 256, None] != ids))
            score = np.concatenate([inner_products(q[at + r[i : i + 65536]], x[c[i : i + 65536]]) for i in range(0, len(r), 65536)] or [np.zeros(0)])
            order = np.lexsort([ids[c], -score, r])
            r, c, score = r[order], c[order], score[order]
            begin = np.searchsorted(r, r, "left")
            top = np.arange(len(r)) - begin < k
            found.append((at + r[top], c[top], score[top]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


# ---------------------------------------------------------------- on Spark


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.asarray(v, np.float64) for v in batch.column("embedding").to_pylist()]
        with np.errstate(over="ignore"):
            size = [float(np.abs(v).max() * np.linalg.norm(v / np.abs(v).max())) for v in rows]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(v) for v in rows], pa.int32()), pa.array(size, pa.float64()), pa.array([v.tobytes() for v in rows], pa.binary())], names=["id", "dim", "size", "vector"])


def _graph_edges(samples: dict):
    """(dim, place, near, goals) of the sample rows of a batch, by comparison with the whole (broadcast) sample: the
    places nearest to a row as it is stored, and as it asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, place = batch.column("dim").to_numpy(), batch.column("place").to_numpy()
            for dim in np.unique(dims).tolist():
                own = place[dims == dim]
                x = samples[dim].value
                lists = [pa.array(list(neighbours(v, x, own)), pa.list_(pa.int64())) for v in (x[own], asked(x[own, :-1]))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), dim), pa.int32()), pa.array(own, pa.int64()), *lists], names=["dim", "place", "near", "goals"])

    return run


def _train(samples: dict, parts: dict):
    def run(table: pa.Table) -> pa.Table:
        """The sample of one length to the classifier's weights, packed."""
        dim = table.column("dim")[0].as_py()
        table = table.sort_by("place")
        graph, goals = (table.column(c).combine_chunks().flatten().to_numpy().reshape(len(table), -1) for c in ("near", "goals"))
        x = samples[dim].value
        part = balanced_parts(graph, parts[dim])
        # a stored row counts itself among its neighbours; as a query it doesn't
        near = np.concatenate([np.concatenate([part[:, None], part[graph[:, 1:]]], axis=1), part[goals]])
        weights = Router.trained(np.concatenate([x, asked(x[:, :-1])]), near, parts[dim]).weights
        return pa.table({"dim": pa.array([dim], pa.int32()), "weights": pa.array([b"".join(w.tobytes() for w in weights)], pa.binary())})

    return run


def _unpacked(data: bytes, dim: int, parts: int) -> Router:
    shapes = [(dim + 1, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
    flat = np.frombuffer(data, np.float32)
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return Router([part.reshape(s) for part, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)])


def _routes(models: dict, most: dict):
    """Stored rows with their most probable part; 0 for lengths without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            part = np.zeros(len(dims), np.int32)
            for dim in models:
                rows = np.flatnonzero(dims == dim)
                if len(rows):
                    v = _matrix(batch.column("vector").take(pa.array(rows)), dim)
                    part[rows] = models[dim].scores(lifted(v, most[dim])).argmax(axis=1)
            yield batch.append_column("part", pa.array(part))

    return run


def _asks(models: dict, bundles: dict, probes: dict):
    """A row a query and bundle that holds parts it is routed to (``parts``); bundles are {dim: that of each part}."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            plain = np.flatnonzero(~np.isin(dims, list(models))).tolist()
            if plain:
                yield from sent(batch, plain, [0] * len(plain), [[0]] * len(plain))
            for dim in models:
                every = np.flatnonzero(dims == dim)
                # a query is copied for each bundle, and has a score for each part
                step = max(1, min((GRAPH_CELLS // 4) // len(bundles[dim]), ASKED_BYTES // (8 * dim * len(np.unique(bundles[dim])))))
                for at in range(0, len(every), step):
                    rows = every[at : at + step]
                    v = _matrix(batch.column("vector").take(pa.array(rows)), dim)
                    order = np.argsort(-models[dim].scores(asked(v)), axis=1, kind="stable")[:, : probes[dim]]
                    take, bundle, parts = [], [], []
                    for i, own in zip(rows.tolist(), order, strict=True):
                        held = bundles[dim][own]
                        for b in np.unique(held).tolist():
                            take.append(i)
                            bundle.append(b)
                            parts.append(own[held == b].tolist())
                    yield from sent(batch, take, bundle, parts)

    def sent(batch: pa.RecordBatch, take: list[int], bundle: list[int], parts: list[list[int]]) -> list[pa.RecordBatch]:
        kept = pa.Table.from_batches([batch]).take(pa.array(take, pa.int64()))
        kept = kept.append_column("bundle", pa.array(bundle, pa.int64())).append_column("parts", pa.array(parts, pa.list_(pa.int32())))
        return kept.combine_chunks().to_batches()

    return run


def _audit(queries, k: int):
    """A task's k nearest rows of each audited query, with the part that each is stored in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim, (q_ids, q) in queries.value.items():
                rows = np.flatnonzero(dims == dim)
                if not len(rows):
                    continue
                ids, part = batch.column("id").to_numpy()[rows], batch.column("part").to_numpy()[rows]
                x = _matrix(batch.column("vector").take(pa.array(rows)), dim)
                r, c, score = nearest(q, q_ids, x, ids, k)
                got = pa.table({"query": q_ids[r], "id": ids[c], "score": score, "part": part[c]})
                if dim in best:
                    got = pa.concat_tables([best[dim], got])
                    query, other, score = (got.column(i).to_numpy() for i in ("query", "id", "score"))
                    order = np.lexsort([other, -score, query])
                    begin = np.searchsorted(query[order], query[order], "left")
                    got = got.take(pa.array(order[np.arange(len(order)) - begin < k]))
                best[dim] = got
        for table in best.values():
            yield from table.combine_chunks().to_batches()

    return run


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        """A page of a bundle of parts and a block of queries to each query's nearest rows in the parts it asks."""
        dim = table.column("dim")[0].as_py()
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if asks.any() and not asks.all():
            base, query = (table.column("vector").take(pa.array(np.flatnonzero(m))) for m in (~asks, asks))
            x, x_ids, q, q_ids = _matrix(base, dim), ids[~asks], _matrix(query, dim), ids[asks]
            lists = table.column("parts").take(pa.array(np.flatnonzero(asks))).combine_chunks()
            wanted, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            part = table.column("parts").take(pa.array(np.flatnonzero(~asks))).combine_chunks().flatten().to_numpy()
            for p in np.unique(part).tolist():
                at, own = row[wanted == p], np.flatnonzero(part == p)
                r, c, score = nearest(q[at], q_ids[at], x[own], x_ids[own], k)
                found.append((at[r], own[c], score))
            r, c, score = (np.concatenate(f) for f in zip(*found, strict=True))
            order = np.lexsort([x_ids[c], -score, r])
            order = order[np.arange(len(order)) - np.searchsorted(r[order], r[order], "left") < k]
            found = [(q_ids[r[order]], x_ids[c[order]], score[order])]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found[0], strict=True)))

    return run


def _top(found: DataFrame, by: str, id_col: str, k: int) -> DataFrame:
    ahead = Window.partitionBy(by).orderBy(F.desc("score"), id_col)
    return found.withColumn("rank", F.row_number().over(ahead)).where(F.col("rank") <= k)


def learned_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_step: int = 20, k: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score, recall, probed for the rows whose id ``query_step`` divides: their k nearest others.

    Nearness is the largest inner product in double precision, added up from the first component on; ties go to the
    smaller id. ``recall`` asks for a share of the true neighbours: 1.0 searches every part, which is exact; below it so
    many parts are searched as reach that share for up to AUDITED queries compared with all rows. The column
    recall is what the result has of their true neighbours, probed the share of the stored rows that queries meet.

    Null, empty and zero vectors and those with a null or non-finite component take no part, nor do rows without an id.
    Rows that bear one id count as one, with the smallest vector. Vectors of different lengths don't meet. Of equal
    vectors only the k + 1 smallest ids can be among anyone's nearest, so no more are stored. Queries without another
    vector of their length have no rows; an empty table gives none; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("embedding")).where("id is not null").where(_GOOD)
    usable = saved(rows.groupBy("id").agg(F.min("embedding").alias("embedding")).mapInArrow(_packed, "id long, dim int, size double, vector binary"), "vectors")
    copies = Window.partitionBy("vector").orderBy("id")
    stored = saved(usable.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "stored")
    queries = usable.where(F.col("id") % query_step == 0)

    sizes = stored.groupBy("dim").agg(F.count("*").alias("n"), F.max("size").alias("most")).orderBy(F.desc("n"), "dim").limit(MODELS).collect()
    sizes = {r["dim"]: r for r in sizes if r["n"] >= 4 * LEAST_PARTS and math.isfinite(r["most"])}
    parts = {d: 1 << max(LEAST_PARTS.bit_length() - 1, min(MOST_PARTS.bit_length() - 1, round(math.log2(r["n"] / PART_ROWS)))) for d, r in sizes.items()}
    most = {d: r["most"] for d, r in sizes.items()}
    models = _fitted(stored, parts, most) if parts else {}

    assigned = saved(stored.drop("size").mapInArrow(_routes(models, most), "id long, dim int, vector binary, part int"), "assigned")
    chosen = queries.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(AUDITED)  # bounded, as is what is collected of it
    truth = _audited(assigned, chosen, k)
    probes = _probes(truth, chosen, models, parts, recall)

    bundled = _bundles(assigned, list(models))
    bundles = {d: np.zeros(parts[d], np.int64) for d in models}
    for r in bundled.where(F.col("dim").isin(list(models))).select("dim", "part", "bundle").collect():  # a row a part
        bundles[r["dim"]][r["part"]] = r["bundle"]
    asks = queries.drop("size").mapInArrow(_asks(models, bundles, probes), "id long, dim int, vector binary, bundle long, parts array<int>")
    asks = saved(asks, "asks")
    pages = bundled.groupBy("dim", "bundle").agg(F.max("pages").alias("pages"))
    load = asks.groupBy("dim", "bundle").agg(F.ceil(F.count("*") / QUERIES).alias("blocks"))
    small = bundled.count() <= 50_000  # a row a part of up to MODELS lengths, and one for each other length
    pages, load, placed = (F.broadcast(t) if small else t for t in (pages, load, bundled))
    met = asks.join(pages, ["dim", "bundle"]).join(load, ["dim", "bundle"])
    met = met.select("dim", "bundle", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)).alias("page"), F.pmod(F.xxhash64("id", F.lit("ask")), F.col("blocks")).alias("block"), "id", "vector", "parts", F.lit(True).alias("asks"))
    base = assigned.join(placed, ["dim", "part"]).join(load, ["dim", "bundle"])
    base = base.select("dim", "bundle", F.pmod(F.xxhash64("id"), F.col("pages")).alias("page"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "id", "vector", F.array("part").alias("parts"), F.lit(False).alias("asks"))
    found = base.unionByName(met).groupBy("dim", "bundle", "page", "block").applyInArrow(_search(k), "query_id long, vec_id long, score double")
    result = saved(_top(found, "query_id", "vec_id", k), "nearest")
    reached = _reached(result, truth, chosen, k)
    every = bundled.groupBy("dim").agg(F.sum("rows").alias("every"))
    share = asks.select("id", "dim", F.explode("parts").alias("part")).join(placed, ["dim", "part"]).groupBy("id", "dim").agg(F.sum("rows").alias("met"))
    share = share.join(every, "dim").agg(F.avg(F.col("met") / F.col("every"))).first()[0]
    return result.select("query_id", "rank", "vec_id", "score", F.lit(reached).cast("double").alias("recall"), F.lit(share).cast("double").alias("probed"))


def _bundles(assigned: DataFrame, modelled: list[int]) -> DataFrame:
    """(dim, part, rows, bundle, pages): small parts side by side in bundles of about a page, large ones cut to pages.

    A task searches a page of a bundle, so a query's best rows leave it once for all its parts there.
    """
    filled = saved(assigned.groupBy("dim", "part").agg(F.count("*").alias("rows")), "parts")
    room = F.greatest(F.lit(1), F.least(F.lit(PAGE), F.floor(F.lit(PAGE_BYTES) / (8 * F.col("dim")))))
    ahead = Window.partitionBy("dim").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    small = F.when(F.col("rows") <= room, F.col("rows")).otherwise(0)
    filled = filled.withColumn("before", F.coalesce(F.sum(small).over(ahead), F.lit(0)))
    own = F.when(F.col("rows") <= room, F.floor(F.col("before") / room)).otherwise(-1 - F.col("part"))
    bundle = F.when(F.col("dim").isin(modelled), own).otherwise(0).cast("long")
    return saved(filled.select("dim", "part", "rows", bundle.alias("bundle"), F.ceil(F.col("rows") / room).alias("pages")), "bundles")


def _fitted(stored: DataFrame, parts: dict, most: dict) -> dict:
    """{dim: Router} from a sample of SAMPLE_ROWS rows a part and at most SAMPLE_BYTES, chosen by a hash of the id."""
    spark = stored.sparkSession
    samples, places = {}, None
    for dim, count in parts.items():
        bound = max(4 * LEAST_PARTS, min(SAMPLE_ROWS * count, SAMPLE_BYTES // (4 * dim)))
        drawn = stored.where(F.col("dim") == dim).orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(bound)
        x = lifted(_matrix(pa.Table.from_batches(drawn.select("vector").toArrow().to_batches()).column("vector"), dim), most[dim])
        samples[dim] = spark.sparkContext.broadcast(x)
        own = spark.range(0, len(x), 1, max(1, len(x) // 1024)).select(F.lit(dim).cast("int").alias("dim"), F.col("id").alias("place"))
        places = own if places is None else places.unionByName(own)
    edges = saved(places.mapInArrow(_graph_edges(samples), "dim int, place long, near array<long>, goals array<long>"), "sample-graph")
    trained = edges.groupBy("dim").applyInArrow(_train(samples, parts), "dim int, weights binary").collect()
    for s in samples.values():
        s.unpersist()
    return {r["dim"]: _unpacked(bytes(r["weights"]), r["dim"], parts[r["dim"]]) for r in trained}


def _audited(assigned: DataFrame, chosen: DataFrame, k: int) -> list:
    """(query, id, score, part) of the true nearest rows of up to AUDITED queries."""
    drawn: dict[int, list] = {}
    for r in chosen.select("id", "dim", "vector").collect():
        drawn.setdefault(r["dim"], []).append((r["id"], np.frombuffer(r["vector"], np.float64)))
    held = {d: (np.array([i for i, _ in own], np.int64), np.stack([v for _, v in own])) for d, own in drawn.items()}
    near = assigned.mapInArrow(_audit(assigned.sparkSession.sparkContext.broadcast(held), k), "query long, id long, score double, part int")
    return _top(near, "query", "id", k).collect()  # k rows an audited query


def _probes(truth: list, chosen: DataFrame, models: dict, parts: dict, recall: float) -> dict:
    """{dim: how many parts to search} so that the share of true neighbours in them is ``recall`` or more."""
    places: dict[int, list[int]] = {d: [] for d in models}
    near: dict[int, list[int]] = {}
    for r in truth:
        near.setdefault(r["query"], []).append(r["part"])
    for r in chosen.select("id", "dim", "vector").collect():
        if r["dim"] in models and r["id"] in near:
            order = np.argsort(-models[r["dim"]].scores(asked(np.frombuffer(r["vector"], np.float64)[None]))[0], kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            places[r["dim"]] += place[near[r["id"]]].tolist()
    out = {}
    for d, own in places.items():
        count = np.bincount(np.array(own, np.int64), minlength=parts[d])
        reach = np.cumsum(count) / max(1, len(own))
        out[d] = parts[d] if recall >= 1.0 or not own else int(np.searchsorted(reach, recall - 1e-12)) + 1
    return out


def _reached(result: DataFrame, truth: list, chosen: DataFrame, k: int) -> float | None:
    """The share of the audited queries' true neighbours that the result has; ties count by their score."""
    least: dict[int, tuple[float, int]] = {}
    for r in truth:
        low, n = least.get(r["query"], (math.inf, 0))
        least[r["query"]] = (min(low, r["score"]), n + 1)
    if not least:
        return None
    got = result.join(F.broadcast(chosen.select(F.col("id").alias("query_id"))), "query_id").select("query_id", "score").collect()  # k rows an audited query
    hits = sum(r["score"] >= least[r["query_id"]][0] for r in got)
    return hits / sum(n for _, n in least.values())
