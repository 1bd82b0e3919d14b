"""The stored vector index against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.vector_index import Quantizer, VectorIndex, searched_with_recall

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def clustered():
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(50, 16))[rnd.integers(0, 50, 2500)] + rnd.normal(scale=0.3, size=(2500, 16))
    x[100:400] = x[100]
    return x.astype(np.float32)


def true_nearest(x, queries, k):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = np.round(u[queries] @ u.T, 12)
    near[np.arange(len(queries)), queries] = -np.inf
    return {q: np.lexsort((np.arange(len(x)), -row))[:k].tolist() for q, row in zip(queries, near, strict=True)}


def test_index(spark, tmp_path, clustered):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered)]
    odd = [(9000, None), (9100, [0.0] * 16), (9200, [1.0, 2.0]), (9300, []), (9400, [float("nan")] * 16), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame([*rows, *odd], SCHEMA).withColumn("cell", F.lit("clash")).withColumn("id", F.lit("clash"))
    index = VectorIndex(spark, f"file://{tmp_path}/index").build(df.where("vec_id < 2000 or vec_id > 9000"), "vec_id", "embedding", cells=40)
    index.refresh(df, "vec_id", "embedding")
    index.refresh(df, "vec_id", "embedding")  # nothing is new
    assert index.ids().count() == 2500 and index.ids().select("batch").distinct().count() == 2
    asked = df.where("vec_id % 100 = 0")
    true = true_nearest(clustered, list(range(0, 2500, 100)), 10)
    exact = index.search(asked, "vec_id", "embedding", 10, 40, 5000).select("query_id", "id", "rank", F.round("score", 9).alias("s"))
    got = {}
    for r in sorted(exact.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == true
    found = searched_with_recall(index, df, asked, "vec_id", "embedding", 10).collect()
    assert len(found) == 250 and found[0]["recall"] >= 0.9 and found[0]["probes"] < 40
    assert index.search(asked.limit(0), "vec_id", "embedding", 10, 4).count() == 0


def test_what_a_failed_batch_left_doesnt_count(spark, tmp_path, clustered):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clustered[:300])], SCHEMA)
    path = f"file://{tmp_path}/index"
    index = VectorIndex(spark, path).build(df.where("vec_id < 200"), "vec_id", "embedding")
    first = index._lists()
    first.where("id < 50").withColumn("id", F.col("id") + 1000).drop("batch").write.partitionBy("part").parquet(f"{path}/lists/batch=torn")
    assert index._lists().count() == 200
    index.refresh(df, "vec_id", "embedding")
    assert sorted(r["id"] for r in index._lists().select("id").collect()) == list(range(300))


def test_codes_are_near_their_vectors():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(2000, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    q = Quantizer.trained(x, 16, 8)
    cell = np.zeros(2000, np.int64)
    near = q.closeness(x[:50], 0, q.codes(x, cell))
    assert np.corrcoef(near.ravel(), (x[:50] @ x.T).ravel())[0, 1] > 0.95


def test_a_slice_gives_k_rows_a_query():
    """Searched whole, a slice of 3,000 rows (all equal but for length) leaves k rows for each query, ties by id."""
    import numpy as np
    import pyarrow as pa

    from tessera.operators import vector_index

    vectors = [[1.0, 2.0, 3.0]] * 3000 + [[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]]
    codes = [b"x"] * 3000 + [None] * 2
    got = vector_index._nearest(3, 5)(pa.table({"id": np.arange(3002), "v": vectors, "code": pa.array(codes, pa.binary())}))
    assert got.column("query_id").to_pylist() == [3000] * 5 + [3001] * 5 and got.column("id").to_pylist() == [0, 1, 2, 3, 4] * 2
    assert np.allclose(got.column("score").to_numpy(), [10 / 14] * 5 + [1.0] * 5)
