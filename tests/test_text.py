import datetime

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.vectors import hash_embed, hash_vector
from tessera.operators import catalog, match


def value(spark, column, **cells):
    row = spark.createDataFrame([tuple(cells.values())], " , ".join(f"{k} string" for k in cells))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "date"),
    [("13/08/2025", (2025, 8, 13)), ("2025-08-13", (2025, 8, 13)), ("12 de mayo de 2020", (2020, 5, 12)), ("2019", None), ("32/01/2020", None), ("", None), (None, None)],
)
def test_dates(spark, raw, date):
    assert value(spark, tx.parse_fecha("c"), c=raw) == (datetime.date(*date) if date else None)


def test_unicode_case_and_space(spark):
    assert value(spark, F.col("c").rlike(tx.rx("constituci[oó]n")), c="CONSTITUCIÓN") is True
    assert value(spark, tx.strip("c"), c="  a b \n") == "a b"
    assert value(spark, tx.squeeze("c"), c=" a \n b ") == "a b"
    assert value(spark, tx.ascii_lower("c"), c="ÉAB") == "Éab"


def test_normalize_and_registry(spark):
    assert value(spark, tx.normalize_name("c"), c="Convención sobre los Derechos del Niño (1989)") == "convencion sobre los derechos del nino 1989"
    name = "Protocolo Facultativo de la Convención contra la Tortura"
    assert value(spark, match.first_key_in(F.col("c"), catalog.TREATY_REGISTRY), c=name) == "IV-9"
    assert value(spark, match.first_key_in(F.col("c"), catalog.TREATY_REGISTRY, compat=False), c=name) == "IV-9-b"
    comma = "Protocolo para Prevenir, Reprimir y Sancionar la Trata de Personas"
    assert value(spark, match.first_key_in(F.col("c"), catalog.TREATY_REGISTRY), c=comma) is None
    assert value(spark, match.first_key_in(F.col("c"), catalog.TREATY_REGISTRY, compat=False), c=comma) == "XVIII-12-a"


def test_html_text(spark):
    html = '<script>var t="</p>";</script><p>a &amp; b</p>'
    assert value(spark, tx.drop_blocks("c"), c=html) == "<p>a &amp; b</p>"
    assert value(spark, tx.text_only(tx.drop_blocks("c"), entities=True), c=html) == "a & b"


@pytest.mark.parametrize(
    ("link", "whole"),
    [("x.pdf", "http://h/a/b/x.pdf"), ("../x.pdf", "http://h/a/x.pdf"), ("../../x.pdf", "http://h/x.pdf"), ("/x.pdf", "http://h/x.pdf"), ("https://o/x", "https://o/x"), ("//o/x", "http://o/x")],
)
def test_absolutize(spark, link, whole):
    assert value(spark, tx.absolutize("c", "http://h/a/b/page.html"), c=link) == whole


def test_names_of_files(spark):
    assert value(spark, tx.basename("c"), c="a/b/file.v2.htm") == "file.v2"
    assert value(spark, tx.url_extension("c"), c="http://h/a.PDF?x=1#y") == "pdf"
    assert value(spark, tx.name_from_url("c"), c="http://h/0123456789ab_Ley%20de_Aguas.pdf") == "Ley de Aguas"


def test_case_key_parts(spark):
    epoch, chamber = tx.clave_parts("c")
    assert value(spark, F.concat_ws(",", epoch, chamber), c="VIII-P-1aS-660") == "VIII,1aS"
    assert value(spark, tx.clave_parts("c")[1], c="V-100") is None


def test_maps_and_arrays(spark):
    m = F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit(""), F.lit("c"), F.lit("y"))
    assert value(spark, tx.flatten_fields(m), c="") == "[a]\nx\n\n[c]\ny"
    assert value(spark, tx.total_length(F.array(F.lit("ab"), F.lit(None), F.lit("c"))).cast("string"), c="") == "3"


def test_hash_embedding(spark):
    got = value(spark, hash_embed(F.col("c"), 5), c="hola")
    assert got == pytest.approx(list(hash_vector("hola", 5))) and all(-1 <= x < 1 for x in got)
    assert value(spark, hash_embed(F.col("c"), 5), c=None) is None
