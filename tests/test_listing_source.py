"""Landed listing pages read at once and as a stream that goes on after a stop."""

import json

from tessera.sources import listing_source

SCHEMA = "slice string, page int, id long, rubro string"


def land(folder, name, page, ids):
    path = folder / f"slice={name}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"page={page}.json").write_text(json.dumps({"total": 100, "pagina": page, "resultados": [{"id": i, **({"rubro": f"r{i}"} if i % 2 else {})} for i in ids]}))


def content(df):
    return sorted((r["slice"], r["page"], r["id"], r["rubro"]) for r in df.collect())


def test_pages(spark, tmp_path):
    listing_source.register(spark)
    folder = tmp_path / "landed"
    read = spark.read.format("landed_listing").schema(SCHEMA).option("path", f"file://{folder}").option("size", 2).option("cap", 5)
    assert read.load().count() == 0
    land(folder, "2020", 1, [1, 2])
    land(folder, "2020", 2, [3])
    land(folder, "a%20b", 1, [])
    land(folder, "2021", 2, [7])  # page 1 is missing
    for page in range(1, 6):
        land(folder, "2022", page, [10 + page])  # the listing shows 5 records: three pages
    want = [("2020", 1, 1, "r1"), ("2020", 1, 2, None), ("2020", 2, 3, "r3"), ("2022", 1, 11, "r11"), ("2022", 2, 12, None), ("2022", 3, 13, "r13")]
    assert content(read.load()) == want


def test_a_stream_goes_on_after_a_stop(spark, tmp_path):
    listing_source.register(spark)
    folder, out, ledger = tmp_path / "landed", f"file://{tmp_path}/out", f"file://{tmp_path}/ledger"

    def run():
        stream = spark.readStream.format("landed_listing").schema(SCHEMA).option("path", f"file://{folder}").load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ledger).start()
        query.processAllAvailable()
        query.stop()
        return content(spark.read.schema(SCHEMA).parquet(out))

    land(folder, "2020", 1, [1, 3])
    assert run() == [("2020", 1, 1, "r1"), ("2020", 1, 3, "r3")]
    land(folder, "2020", 3, [9])  # not before page 2
    assert len(run()) == 2
    land(folder, "2020", 2, [5])
    land(folder, "2021", 1, [7])
    assert run() == [("2020", 1, 1, "r1"), ("2020", 1, 3, "r3"), ("2020", 2, 5, "r5"), ("2020", 3, 9, "r9"), ("2021", 1, 7, "r7")]
    assert len(run()) == 5
