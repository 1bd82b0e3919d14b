"""Plans of what to fetch, as DataFrames: pages of a capped listing, days, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ascii_lower


def page_plan(slices: DataFrame, total: str, size: int = 50, cap: int = 9999) -> DataFrame:
    """slices with a row for each page that a listing which shows at most ``cap`` results has; empty slices have none."""
    pages = F.ceil(F.least(F.col(total), F.lit(cap)) / size).cast("int")
    return slices.where(F.col(total) > 0).select("*", F.explode(F.sequence(F.lit(1), pages)).alias("page"), F.lit(size).alias("size"))


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day from first to last, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias("day"))


def candidates(limits: DataFrame, year: str, most: str, patterns: list[str]) -> DataFrame:
    """(url): every pattern filled with every year of ``limits`` and the numbers from 1 to the year's ``most``, each address
    once; patterns use {year} and {n}. Years without a number have none."""
    grid = limits.where(F.col(most) > 0).select(F.col(year).alias("year"), F.explode(F.sequence(F.lit(1), F.col(most).cast("int"))).alias("n"))
    filled = [F.replace(F.replace(F.lit(p), F.lit("{year}"), F.col("year").cast("string")), F.lit("{n}"), F.col("n").cast("string")) for p in patterns]
    return grid.select(F.explode(F.array(*filled)).alias("url")).distinct()


def legislation_ids(df: DataFrame, scope: str) -> DataFrame:
    """Identifiers of laws in force by scope: priority (codes, constitutions and organic laws, federal and of states),
    federal, tratados, estatales_codigos (codes and constitutions of states), or all: the first three without repeats."""
    valid = df.where("vigencia = 'VIGENTE'")
    name = ascii_lower("ordenamiento")
    codes = name.like("codigo%") | name.like("constitucion%")
    by = {
        "priority": valid.where(F.col("ambito").isin("FEDERAL", "ESTATAL") & (codes | name.like("ley org%"))),
        "federal": valid.where("ambito = 'FEDERAL'"),
        "tratados": valid.where("ambito = 'TRATADOS INTERNACIONALES'"),
        "estatales_codigos": valid.where((F.col("ambito") == "ESTATAL") & codes),
    }
    by = {k: v.select("id_native") for k, v in by.items()}
    return by["priority"].union(by["federal"]).union(by["tratados"]).distinct() if scope == "all" else by[scope]
