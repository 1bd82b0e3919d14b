"""All pairs of blocks: what is shuffled grows with the rows, not with their pairs, and no link is missing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import embed_dedup, media
from tessera.llm.components import Forest


def shuffled(spark, work):
    """Bytes that work() writes to shuffles."""
    context = spark.sparkContext._jsc.sc()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway

    def stages():
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (found.apply(k) for k in range(found.size()))}

    before = stages()
    work()
    return sum(v for k, v in stages().items() if k not in before)


def recordings(n):
    """n random fingerprints, large beside what shuffles compress together, and, for each third, a noisy part of it."""
    rnd = np.random.default_rng(n)
    songs = [rnd.integers(0, 1 << 32, 300, np.uint32) for _ in range(n)]
    return songs + [f[2:] ^ (rnd.random(298) < 0.3).astype(np.uint32) for f in songs[::3]]


def test_recordings_shuffle_by_rows(spark, monkeypatch):
    monkeypatch.setattr(media, "BLOCK", 8)
    written = []
    for n in (60, 120):
        prints = recordings(n)
        heads = spark.createDataFrame([(i, f.astype("<u4").tobytes()) for i, f in enumerate(prints)], "id long, prints binary")
        found = []
        written.append(shuffled(spark, lambda: found.extend(media._links(media._blocks(heads), media.voted).collect())))
        parts = Forest()
        for i, root in found:
            parts.add(np.array([i]), np.array([root]))
        assert parts.roots().T.tolist() == [[n + k, 3 * k] for k in range(len(prints) - n)]
    assert 0 < written[1] < 3 * written[0], written


def vectors(n):
    """n random vectors and, for each third, one within range of it."""
    x = np.random.default_rng(n).normal(size=(n, 256))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([x, x[::3] + 0.05 * np.roll(x[::3], 1, axis=0)])


def linked(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.93
    np.fill_diagonal(close, False)
    return close.sum(axis=1).tolist()


def test_vectors_shuffle_by_rows(spark, monkeypatch):
    """Many blocks, and many strips of them."""
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    monkeypatch.setattr(embed_dedup, "STRIP_BYTES", 1 << 17, raising=False)
    written = []
    for n in (120, 240):
        x = vectors(n)
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
        got = {}
        written.append(shuffled(spark, lambda: got.update({r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicate_vectors(df).collect()})))
        assert [got[i] for i in range(len(x))] == linked(x)
    assert 0 < written[1] < 3 * written[0], written


def test_links_that_no_audited_vector_has(spark, monkeypatch):
    """Searches that miss all links of the vectors that aren't audited: they are in the result, which isn't called exact."""
    monkeypatch.setattr(embed_dedup, "LEAST_AUDITED", 1)
    search = embed_dedup._graph_links

    def half_blind(*asked):
        found = search(*asked)
        kept = found.where((F.col("id") % 100 == 0) | (F.col("other") % 100 == 0))
        kept.saved_at = found.saved_at
        return kept

    monkeypatch.setattr(embed_dedup, "_graph_links", half_blind)
    x = vectors(300)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == linked(x)
    assert all(got[300 + k]["component_id"] == 3 * k for k in range(100))
    assert not got[0]["exact"] and got[0]["audit_recall"] == 1.0


@pytest.mark.parametrize("most", [1 << 20, 10])
def test_forest(monkeypatch, most):
    """Links in portions, and matrices with few and with many of them."""
    monkeypatch.setattr("tessera.llm.components.FOREST_LINKS", most)
    rnd, forest = np.random.default_rng(3), Forest()
    part = np.arange(120)
    for share in (0.002, 0.5, 0.01, 0.0):
        ids_a, ids_b = rnd.permutation(60)[:30], 60 + rnd.permutation(60)[: 30 if share < 0.5 else 4]
        close = rnd.random((len(ids_a), len(ids_b))) < share
        forest.add_close(close, ids_a, ids_b)
        for i, j in np.argwhere(close):
            a, b = part[ids_a[i]], part[ids_b[j]]
            part[part == max(a, b)] = min(a, b)
    assert dict(forest.roots().T.tolist()) == {i: int(p) for i, p in enumerate(part) if p != i}
    assert Forest().roots().shape == (2, 0)
