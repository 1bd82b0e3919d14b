"""Reading landed files: tables, JSON listings, HTML and binary documents. Networks and browsers are left to others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def database_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table over JDBC, for databases whose driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def listings(spark: SparkSession, path: str, schema: str | StructType, records: str = "resultados") -> DataFrame:
    """Records of landed listing pages (JSON envelopes), with the page that each came from."""
    pages = spark.read.schema(schema).option("multiLine", True).json(path)
    return pages.select(F.col("pagina"), F.explode(records).alias("r")).select("pagina", "r.*")


def html_files(spark: SparkSession, path: str, least: int = 500) -> DataFrame:
    """(path, html) of whole files of at least ``least`` characters."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("html"))
    return files.where(F.length("html") >= least)


def binary_documents(spark: SparkSession, path: str, magic: bytes = b"%PDF-", least: int = 2000) -> DataFrame:
    """(path, length, content) of binary files that begin with ``magic`` and aren't stubs."""
    files = spark.read.format("binaryFile").load(path)
    return files.where((F.col("length") >= least) & (F.substring("content", 1, len(magic)) == F.lit(bytearray(magic)))).select("path", "length", "content")


def extracted_text(documents: DataFrame, extract: Callable[[bytes, int | None], str | None], pages: int | None = None) -> DataFrame:
    """(path, text): what ``extract`` (any PDF library's) makes of each document, up to ``pages`` pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "text": [extract(c, pages) for c in batch["content"]]})

    return documents.select("path", "content").mapInPandas(run, "path string, text string")


def records_of(ids: DataFrame, landed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the landed records of the ids asked for, the ids without one): a lookup by id over files instead of a service."""
    asked = ids.select(key).distinct()
    return landed.join(asked, key, "left_semi"), asked.join(landed.select(key), key, "left_anti")
