"""How much Spark hands to a Python task at once."""

import pyarrow as pa

from tessera.llm.common import BATCH_BYTES, small_batches


def test_batches_are_small_unless_set(spark):
    """Stages hand texts to Python in batches of some 2 MB; a setting of the session's own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    df = spark.range(0, 8000, 1, 1).selectExpr("repeat('x', 1000 + cast(id % 2 as int)) as text")
    sizes = lambda: [r["n"] for r in df.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long").collect()]
    try:
        small_batches(spark)
        found = sizes()
        assert len(found) >= 3 and max(found) < 1.1 * BATCH_BYTES and sum(found) > 8_000_000
        spark.conf.set(key, "64m")
        small_batches(spark)
        assert spark.conf.get(key) == "64m" and len(sizes()) == 1
    finally:
        spark.conf.unset(key)
