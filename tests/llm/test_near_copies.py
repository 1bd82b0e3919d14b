"""Components from portions of links, and what near-duplicates cost where every shuffle has many tasks."""

import random

import pytest

from tessera.llm import common, minhash
from test_operators import brute_components, edited_copies

TEXTS = "doc_id long, text string"


def smallest_reached(edges):
    part = {}

    def root(x):
        part.setdefault(x, x)
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            one, two = sorted((root(a), root(b)))
            part[two] = one
    return {x: root(x) for x in list(part) if root(x) != x}


@pytest.mark.parametrize("most", [200_000, 0])
def test_hooked_components(spark, monkeypatch, most):
    """A long chain, stars with the largest or smallest id in the middle, random links; joined by broadcasts and by shuffles."""
    from tessera.llm.components import hooked_components

    monkeypatch.setattr(common, "MOST_BROADCAST_ROWS", most)
    rnd = random.Random(5)
    chain = rnd.sample(range(100), 40)
    edges = [*zip(chain, chain[1:]), *[(199, i) for i in range(100, 120)], *[(i, 200) for i in range(201, 220)]]
    edges += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    edges += [(-5, -9), (-9, -7), (7, 7), (None, 3), (3, None), (None, None), *edges[:9], *[(b, a) for a, b in edges[:9]]]
    got = hooked_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert len(got) == len({r["id"] for r in got}) and {r["id"]: r["component_id"] for r in got} == smallest_reached(edges)
    assert hooked_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_near_copies_joined_by_shuffles(spark, monkeypatch):
    """No step relies on a small side; ids that are repeated with other texts have the links of all of them."""
    for module in (common, minhash):
        monkeypatch.setattr(module, "MOST_BROADCAST_ROWS", 0)
    monkeypatch.setattr(minhash, "MOST_BROADCAST_IDS", 0)
    for name, value in (("BLOCK_DOCS", 25), ("FEW_BLOCK_PAIRS", 0), ("PAIRED", 2), ("LEADS", 6)):
        monkeypatch.setattr(minhash, name, value)
    rows = edited_copies(random.Random(12))
    rows += [(3, "one two three four five six seven"), (900, "one two three four five six seven"), (3, "a b"), (901, "A B"), (902, None)]
    part, _ = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, TEXTS)).collect()}
    assert got == part and got[900] == got[901] == got[3]


def test_tasks_where_shuffles_have_many(spark):
    """Groups of near copies, and 40 tasks a shuffle: links are contracted, and small sides aren't shuffled."""
    rows = edited_copies(random.Random(12))
    part, _ = brute_components(rows)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("near copies", "")
        got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, TEXTS)).collect()}
        stages = {s for j in tracker.getJobIdsForGroup("near copies") for s in tracker.getJobInfo(j).stageIds}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tasks = sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    print("tasks", tasks)
    assert got == part and 0 < tasks < 2_000
