"""Objects called from SQL beside their DataFrame form."""

import pytest
from pyspark.sql import functions as F

from depotflow.plans import objects, sql_objects


@pytest.fixture()
def call(star):
    sql_objects.register(star)
    return star.spark.sql


def test_table_functions_match_the_data_frame_form(star, call, rows):
    assert rows(call("SELECT * FROM fk_lftart()")) == rows(objects.deliveries_of(star))
    assert rows(call("SELECT * FROM fk_lftart(jahr => 1990, ort => 'LUDWIGSHAFEN ')")) == rows(
        objects.deliveries_of(star, "Ludwigshafen", 1990))
    for name in ("lieferant", " ARTIKEL", "keine"):
        assert rows(call(f"SELECT * FROM fk_lieferartikel('{name}')")) == rows(objects.number_name_place(star, name))
    for month in ("8", " August", "juli", "0", "13", "Brumaire", "99999999999"):
        assert rows(call(f"SELECT * FROM fk_liefmonat('{month}')")) == rows(objects.deliveries_in_month(star, month))
    for colour in (None, "Rot", "blau"):
        given = "" if colour is None else f"'{colour}'"
        assert rows(call(f"SELECT * FROM farb_art({given})")) == rows(objects.parts_by_colour(star, colour))


def test_views_and_scalar_functions(star, call, rows):
    for name, build in sql_objects.VIEWS.items():
        assert rows(call(f"SELECT * FROM {name}")) == rows(build(star))
    made = call("SELECT ldatum, isowoche(ldatum), fk_datsep(ldatum, '#'), fk_plzvalid(lnr), fk_plzvalid('67059') FROM lieferung")
    wanted = star.lieferung.select(
        "ldatum", objects.OBJECTS["isowoche"]("ldatum"), objects.OBJECTS["fk_datsep"]("ldatum", "#"), F.lit(False), F.lit(True))
    assert rows(made) == rows(wanted)
    assert call("SELECT fk_plzvalid(NULL) AS a").first().a is False


def test_filters_reach_the_scan_through_a_call(spark, tmp_path, star):
    path = str(tmp_path / "lieferung")
    star.lieferung.write.parquet(path)
    sql_objects.register(star)
    spark.read.parquet(path).createOrReplaceTempView("lieferung")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION fk_lftart("
              "ort STRING DEFAULT 'Hamburg', jahr INT DEFAULT 1990) RETURNS TABLE RETURN "
              + next(body for head, body in sql_objects.FUNCTIONS.items() if head.startswith("fk_lftart")))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = spark.sql("SELECT lnr FROM fk_lftart('Hamburg', 1990) WHERE lnr = 'L01'")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines()[::-1] if "FileScan" in line)
    assert "GreaterThanOrEqual(ldatum" in scan and "EqualTo(lnr,L01)" in scan
    assert "lmenge" not in scan.split("ReadSchema")[1]
