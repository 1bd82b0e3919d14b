"""Versions of stored tables: whole or not at all, batches once, older ones readable."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import upsert
from tessera.sources.versioned import VersionConflict, VersionedTable


def content(df):
    return sorted(tuple(r) for r in df.collect())


def last(old, new):
    return upsert.last_wins(old, new, ["id"], "n")


def test_upserts_and_versions(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", ["id"], buckets=8)
    with pytest.raises(ValueError):
        table.read()
    schema = "id long, n long, v string"
    first = spark.createDataFrame([(i, 1, f"a{i}") for i in range(50)], schema)
    assert table.apply(first, "one", last)
    second = spark.createDataFrame([(3, 2, "b"), (3, 1, "c"), (99, 1, None)], schema)
    assert table.apply(second, "two", last) and not table.apply(second, "two", last)
    want = {**{i: (i, 1, f"a{i}") for i in range(50)}, 3: (3, 2, "b"), 99: (99, 1, None)}
    assert {r[0]: r for r in content(table.read())} == want and table.versions() == [1, 2]
    assert content(table.read(1)) == content(first)
    assert table.apply(first.limit(0), "three", last) and content(table.read()) == content(table.read(2))
    one, two = table._manifest(1)["folders"], table._manifest(2)["folders"]
    assert 0 < sum(one[b] != two[b] for b in one) <= 2  # only the buckets of the keys that came
    gone = spark.createDataFrame([(3, 9, "x")], schema)
    table.apply(gone, "four", lambda old, new: old.join(new.select("id"), "id", "left_anti"))
    assert 3 not in {r[0] for r in content(table.read())}
    before = content(table.read())
    table.forget()
    assert table.versions() == [4] and content(table.read()) == before


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", ["id"], buckets=4)
    rows = spark.createDataFrame([(i, 1, "a") for i in range(20)], "id long, n long, v string")
    table.apply(rows, "one", last)

    def failing(old, new):
        return last(old, new).withColumn("v", F.when(F.col("id") < 15, "b").otherwise(F.raise_error(F.lit("lost"))))

    with pytest.raises(Exception, match="lost"):
        table.apply(rows.withColumn("n", F.lit(2).cast("long")), "two", failing)
    assert content(table.read()) == content(rows) and table.versions() == [1]
    assert table.apply(rows.withColumn("n", F.lit(2).cast("long")), "two", last)
    assert {r[1] for r in content(table.read())} == {2}


def test_two_writers(spark, tmp_path):
    one, two = (VersionedTable(spark, f"file://{tmp_path}/t", ["id"], buckets=4) for _ in range(2))
    rows = spark.createDataFrame([(1, 1, "a")], "id long, n long, v string")
    one.apply(rows, "one", last)

    def meanwhile(old, new):
        one.apply(rows.withColumn("v", F.lit("b")).withColumn("n", F.lit(2).cast("long")), "other", last)
        return last(old, new)

    with pytest.raises(VersionConflict):
        two.apply(rows.withColumn("n", F.lit(3).cast("long")), "two", meanwhile)
    assert content(two.read()) == [(1, 2, "b")]


def test_children_are_replaced_at_once(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", ["doc"], buckets=4)
    chunks = spark.createDataFrame([(d, k, f"{d}-{k}") for d in (1, 2, None) for k in range(3)], "doc long, k long, text string")
    replace = lambda old, new: upsert.replace_children(old, new, "doc")
    table.apply(chunks, "one", replace)
    table.apply(spark.createDataFrame([(1, 0, "new")], chunks.schema), "two", replace)
    got = table.read()
    assert content(got.where("doc = 1")) == [(1, 0, "new")] and got.count() == 7
