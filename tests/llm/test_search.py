"""Learned partitions, exact whitening and spelling variants against brute force, and on odd tables."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import learned_ann, variants, whitening

VECTORS = "vec_id long, embedding array<float>, label int"
ODD = [(9001, None, 1), (9002, [0.0] * 12, 1), (9003, [float("nan")] + [1.0] * 11, 1), (9004, [None] + [1.0] * 11, 1), (9005, [], 1), (9006, [float("inf")] + [0.0] * 11, 0)]


# ---------------------------------------------------------------- 11 learned partitions


def brute_neighbours(rows, step, k):
    """{query: [(id, score)]} of rows (id, vector)."""
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    out = {}
    for i, q in rows:
        if i % step == 0:
            score = learned_ann.inner_products(np.repeat(q[None], len(x), 0), x)
            order = [j for j in np.lexsort([ids, -score]) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


@pytest.fixture(scope="module")
def clustered():
    """Clusters with one large group of copies, ties, and lengths that differ."""
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(40, 12))
    x = centres[rnd.integers(0, 40, 3000)] + rnd.normal(scale=0.25, size=(3000, 12))
    x[500:1500] = x[500]
    return x.astype(np.float32)


def test_neighbours(spark, clustered):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered)]
    df = spark.createDataFrame([*rows, *ODD, (None, rows[0][1], 0), (9020, [1.0, 2.0], 0), (9040, [3.0, 1.0], 0), (9060, [1.0] * 5, 0)], VECTORS).withColumn("score", F.lit("clash")).withColumn("part", F.lit(7))
    good = [(i, v.astype(float)) for i, v in enumerate(clustered)]
    true = brute_neighbours(good, 20, 20)
    for asked in (1.0, 0.93):
        got = {}
        found = learned_ann.learned_neighbours(df, recall=asked).collect()
        for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got.pop(9020) == [(9040, 5.0)] and got.pop(9040) == [(9020, 5.0)]
        assert set(got) == set(true) and all(len(v) == 20 for v in got.values())
        if asked == 1.0:
            assert got == true and found[0]["recall"] == found[0]["probed"] == 1.0
        else:
            exact = dict(good)
            hits = sum(len({i for i, _ in got[q]} & {i for i, _ in true[q]}) for q in true) / (20 * len(true))
            assert hits >= 0.9 and found[0]["recall"] >= 0.9 and found[0]["probed"] < 0.8, (hits, found[0])
            for q, own in got.items():
                assert own == sorted(own, key=lambda p: (-p[1], p[0]))
                assert all(s == learned_ann.inner_products(exact[q][None], exact[i][None])[0] for i, s in own)


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (20, [2.0, 1.0], 0), (20, [2.0, 1.0], 0), (3, [1e200, 1.0], 0), (4, [-1e200, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in learned_ann.learned_neighbours(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3, 1e200), (0, 2, 20, 2.0), (0, 3, 4, -1e200), (20, 1, 3, 2e200), (20, 2, 0, 2.0), (20, 3, 4, -2e200)]
    assert learned_ann.learned_neighbours(few.limit(0)).count() == 0
    assert learned_ann.learned_neighbours(few.where("vec_id = 20")).count() == 0


def test_parts_are_balanced_and_break_few_edges():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(16, 8))[np.repeat(np.arange(16), 32)] + rnd.normal(scale=0.1, size=(512, 8))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = learned_ann.neighbours(x, x, np.arange(512))
    part = learned_ann.balanced_parts(graph, 16)
    assert set(np.bincount(part, minlength=16)) == {32}
    assert (part[graph] != part[:, None]).mean() < 0.15
    router = learned_ann.Router.trained(x, part[graph], 16)
    assert (router.scores(x).argmax(axis=1) == part).mean() > 0.8


# ---------------------------------------------------------------- 12 whitening


def test_whitening(spark):
    rnd = np.random.default_rng(2)
    x = (rnd.normal(size=(400, 12)) @ rnd.normal(size=(12, 12))).astype(np.float32)
    x[200:300] = x[200]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame([*rows, *[o for o in ODD if o[0] != 9002], (None, rows[1][1], 0), (1, rows[2][1], 0), (9030, [5.0], 0), (9031, [1e30] * 12, 0)], VECTORS).withColumn("component", F.lit("clash")).withColumn("x", F.lit(1))
    got = whitening.whitened_vectors(df).collect()
    own = [(i, np.floor(256 * v.astype(float)).astype(np.int64)) for i, v in enumerate(x)] + [(None, np.floor(256 * x[1].astype(float)).astype(np.int64)), (1, np.floor(256 * x[2].astype(float)).astype(np.int64))]
    fit = np.unique(np.stack([v for _, v in own]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    alone = by.pop((9030, 0))
    assert (alone[1]["n"], alone[1]["whitened"], alone[1]["explained"], len(alone)) == (1, None, 0.0, 1)
    assert sum(len(v) for v in by.values()) == 4 * len({(i, int(((n * v - sums) ** 2).sum())) for i, v in own})
    sign = {}
    for i, v in own:
        mine = by[(i, int(((n * v - sums) ** 2).sum()))]
        for k in range(1, 5):
            r = mine[k]
            expected = float((v - sums / n) @ vectors[:, -k] / np.sqrt(values[-k]))
            sign.setdefault(k, np.sign(r["whitened"] * expected))
            assert abs(sign[k] * r["whitened"] - expected) < 1e-9 and r["n"] == n
            assert abs(r["explained"] / (values[-k] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9
    assert whitening.whitened_vectors(df.limit(0)).count() == 0


def test_rank_and_large_components(spark):
    """Components without variance are null; what no 64-bit integer holds is null, too."""
    rnd = np.random.default_rng(5)
    flat = np.outer(rnd.integers(-50, 50, size=30), [1.0, 2.0, 3.0, 4.0, 5.0])
    got = whitening.whitened_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "vec_id long, embedding array<double>")).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got) and got[0]["identity_error"] < 1e-9
    large = spark.createDataFrame([(i, [float(rnd.integers(-1, 2)) * 1e15, float(i)]) for i in range(20)], "vec_id long, embedding array<double>")
    got = whitening.whitened_vectors(large).collect()
    assert len(got) == 40 and all(r["deviation"] is None for r in got) and got[0]["identity_error"] < 1e-6


@pytest.mark.parametrize("most", [100, 10**9, 2**60])
def test_limb_products_are_exact(most):
    rnd = np.random.default_rng(4)
    x = rnd.integers(-most, most, size=(300, 5))
    sums = [int(v) for v in x.astype(object).sum(axis=0)]
    y = x.astype(object) * 300 - np.array(sums, object)
    gram = whitening.Gram(5)
    for part in np.split(x, 3):
        gram.add(whitening.centred(part, 300, sums))
    assert (gram.value() == y.T @ y).all()
    flat = gram.value().ravel().tolist()
    assert whitening.from_digits(whitening.digits(flat, whitening.PRODUCT_DIGITS)) == flat


# ---------------------------------------------------------------- 13 spelling variants


def one_edit(a, b):
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a != b and (a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:])


def brute_variants(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    out, forms = {}, {}
    for w in n:
        near = [u for u in n if abs(len(u) - len(w)) <= 1 and one_edit(w, u)]
        best = min(near, key=lambda u: (-n[u], u), default=None)
        forms[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = len(near)
    roots = {}
    for w in n:
        at = w
        while forms[at]:
            at = forms[at]
        roots[w] = at
    return {w: (forms[w], roots[w], n[w], out[w], n[forms[w]] if forms[w] else None) for w in n}


def variant_rows(rnd):
    letters = "abcdeñÑÁéA"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(4, 12))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "babab", "x" * 3000, "x" * 3001]
    words = list(base)
    for w in base * 3:
        p = rnd.randrange(len(w))
        words.append(rnd.choice([w[:p] + w[p + 1 :], w[:p] + rnd.choice(letters) + w[p:], w[:p] + rnd.choice(letters) + w[p + 1 :]]))
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60))) + rnd.choice(["", ".", "1a", " ×÷ "])) for i in range(300)]
    rows += [(6000, "morazul " * 4 + "morazal " * 9 + "morezal " * 20)]
    return rows + [(None, "aaaaa aaaaa aaaaab"), (None, None), (5000, ""), (5001, "palabra " * 20_000 + "palabrx palabrx palabrx"), rows[0], rows[0]]


@pytest.mark.parametrize("chars", [variants.SHARD_CHARS, 60])
def test_variants(spark, monkeypatch, chars):
    monkeypatch.setattr(variants, "SHARD_CHARS", chars)  # few: most keys are cut to pages
    rows = variant_rows(random.Random(8))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants.spelling_variants(df).collect()}
    want = brute_variants(rows)
    assert got == want and sum(v[3] for v in want.values()) > 200 and any(v[1] != v[0] and v[0] for v in want.values())
    assert variants.spelling_variants(df.limit(0)).count() == 0


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({"".join(random.Random(i).choices("abc", k=5 + i % 3)) for i in range(900)})
    a = variants.Automaton(words)
    assert len(a.final) < len(variants._trie(words)[0]) / 2
    languages = {}
    for s in range(len(a.final)):  # lower states first: targets are known
        edges = tuple((int(a.label[e]), languages[int(a.target[e])]) for e in range(a.first[s], a.first[s + 1]))
        languages[s] = hash((bool(a.final[s]), edges))
    assert len(set(languages.values())) == len(a.final)
    for length in (5, 6, 7):
        own = [w for w in words if len(w) == length]
        row, number = a.one_error(variants._codes(own)[0].reshape(len(own), length), 0)
        assert sorted((own[r], words[k]) for r, k in zip(row, number, strict=True)) == sorted((w, u) for w in own for u in words if one_edit(w, u))
