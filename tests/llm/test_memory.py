"""What a Python task of the vector search holds at once."""

import numpy as np
import pyarrow as pa

from tessera.llm import learned_ann


def test_graph_and_queries_are_bounded(monkeypatch):
    """Neither the products of a row block with the sample nor the copies of queries for bundles grow with the sample."""
    import tracemalloc

    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(40_000, 9)).astype(np.float32)
    own = np.arange(512)
    tracemalloc.start()
    found = learned_ann.neighbours(x[own], x, own, 5)
    peak = tracemalloc.get_traced_memory()[1]
    assert peak < 150e6  # 512 rows at once took over 300 MB
    near = x[own].astype(float) @ x.T.astype(float)
    near[own, own] = -np.inf
    best = np.sort(near, axis=1)[:, -5:]
    assert np.allclose(np.sort(np.take_along_axis(near, found, 1), axis=1), best, atol=1e-5)

    dim, parts = 8, 256
    shapes = [(dim + 1, learned_ann.HIDDEN), (learned_ann.HIDDEN,), (learned_ann.HIDDEN, parts), (parts,)]
    model = learned_ann.Router([rnd.normal(size=s).astype(np.float32) for s in shapes])
    v = rnd.normal(size=(600, dim))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(600)), pa.array([dim] * 599 + [3], pa.int32()), pa.array([r.tobytes() for r in v], pa.binary())], names=["id", "dim", "vector"])
    bundles = {dim: np.arange(parts) // 2}
    monkeypatch.setattr(learned_ann, "ASKED_BYTES", 1 << 20)
    out = list(learned_ann._asks({dim: model}, bundles, {dim: parts})(iter([batch])))
    tracemalloc.stop()
    assert max(b.num_rows for b in out) * 8 * dim <= 1 << 20
    whole = pa.Table.from_batches(out).to_pylist()
    assert len(whole) == 599 * 128 + 1 and {(r["id"], p) for r in whole if r["id"] < 599 for p in r["parts"]} == {(i, p) for i in range(599) for p in range(parts)}
    assert all(r["vector"] == v[r["id"]].tobytes() and all(p // 2 == r["bundle"] for p in r["parts"]) for r in whole)
