"""Aggregates, sub-totals and ranks over the model tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotflow.functions import dates, numbers, text
from depotflow.operators import grouping, numbering
from depotflow.plans.registry import query


def delivery_figures(star):
    return star.lieferung.agg(
        F.sum("lmenge").alias("summe"), F.max("lmenge").alias("groesste"), F.min("lmenge").alias("kleinste"),
        F.avg("lmenge").alias("mittel"), F.count("lnr").alias("anzahl"),
    )


@query("a1_figures", """
    SELECT CAST(sum(lmenge) AS BIGINT) AS summe, max(lmenge) AS groesste, min(lmenge) AS kleinste,
           round(sum(lmenge) / count(*), 6) AS mittel, count(*) AS anzahl FROM lieferung""")
def _(star):
    return delivery_figures(star).withColumn("mittel", F.round("mittel", 6))


@query("a1_last_delivery", "SELECT max(l_shipdate) AS letzte FROM lineitem WHERE l_partkey = 2")
def _(star):
    return star.lieferung.filter(F.col("anr") == 2).agg(F.max("ldatum").alias("letzte"))


@query("a2_counts", """
    SELECT count(lnr) AS nummern, count(*) AS zeilen, sum(CASE WHEN status IS NULL THEN 0 ELSE 1 END)::BIGINT AS werte
    FROM lieferant""")
def _(star):
    return star.lieferant.agg(
        F.count("lnr").alias("nummern"), F.count("*").alias("zeilen"), F.count("status").alias("werte")
    )


@query("a3_distinct_count", """
    SELECT count(*) AS lieferanten FROM (SELECT lnr FROM lieferung GROUP BY lnr)""")
def _(star):
    return star.lieferung.agg(F.countDistinct("lnr").alias("lieferanten"))


# Five standard deviations of the sketches: none of the estimates lies further off.
@query("a3_sketched_rollup", """
    WITH je AS (SELECT lnr, year(ldatum) AS jahr, month(ldatum) AS monat FROM lieferung),
    ebenen AS (SELECT jahr, monat, grouping_id(jahr, monat) AS ebene FROM je GROUP BY ROLLUP (jahr, monat))
    SELECT CAST(ebene AS INTEGER) AS ebene, count(*) AS gruppen, CAST(0 AS BIGINT) AS daneben FROM ebenen GROUP BY ebene""")
def _(star):
    rows = star.lieferung.select("lnr", F.year("ldatum").alias("jahr"), F.month("ldatum").alias("monat"))
    exact = rows.distinct().rollup("jahr", "monat").agg(
        F.countDistinct("lnr").alias("genau"), F.grouping_id().cast("int").alias("ebene"))
    found = grouping.level_distinct(rows, ["jahr", "monat"], "lnr", "etwa").select(
        F.col("jahr").alias("j"), F.col("monat").alias("m"), F.col("ebene").alias("e"), "etwa")
    same = F.col("ebene").eqNullSafe(F.col("e")) & F.col("jahr").eqNullSafe(F.col("j")) & F.col("monat").eqNullSafe(F.col("m"))
    off = F.abs(F.col("etwa") - F.col("genau")) > 5 * 1.04 / 64 * F.col("genau")
    return exact.join(found, same, "left").groupBy("ebene").agg(
        F.count("*").alias("gruppen"), F.count_if(F.coalesce(off, F.lit(True))).alias("daneben"))


@query("a4_group_by_key", "SELECT lnr, max(lmenge) AS groesste FROM lieferung GROUP BY lnr")
def _(star):
    return star.lieferung.groupBy("lnr").agg(F.max("lmenge").alias("groesste"))


# The level words are counted from the month, so that names need no place in the SQL.
def by_month(star, at_least):
    return star.lieferung.filter(F.col("lmenge") >= at_least).select(
        "lnr", F.month("ldatum").alias("monat"), F.year("ldatum").alias("jahr"), "lmenge"
    )


MONTHLY = """
    SELECT lnr, month(ldatum)::INTEGER AS monat, year(ldatum)::INTEGER AS jahr, lmenge FROM lieferung WHERE lmenge >= 10"""


@query("a5_group_by_expressions", f"""
    SELECT lnr, monat, jahr, CAST(sum(lmenge) AS BIGINT) AS gesamtliefermenge FROM ({MONTHLY}) GROUP BY ALL""")
def _(star):
    return by_month(star, 10).groupBy("lnr", "monat", "jahr").agg(F.sum("lmenge").alias("gesamtliefermenge"))


@query("a6_aggregate_of_expression", "SELECT round(max(gewicht / 1000 * amenge), 3) AS groesstes_gewicht FROM artikel")
def _(star):
    return star.artikel.agg(F.max(numbers.kilograms("gewicht") * F.col("amenge")).alias("groesstes_gewicht"))


@query("a7_having", """
    SELECT lstadt, hoechster FROM (
        SELECT lstadt, max(status) AS hoechster, avg(status) AS mittel FROM lieferant GROUP BY lstadt)
    WHERE mittel > 45""")
def _(star):
    return status_by_place(star.lieferant, 45)


def status_by_place(suppliers, above):
    grouped = suppliers.groupBy("lstadt").agg(F.max("status").alias("hoechster"), F.avg("status").alias("mittel"))
    return grouped.filter(F.col("mittel") > above).drop("mittel")


@query("a8_where_before_having", """
    SELECT n_name AS lstadt, hoechster FROM nation JOIN (
        SELECT s_nationkey, CAST(max(floor(s_acctbal / 100)) AS INTEGER) AS hoechster FROM supplier
        WHERE s_acctbal >= 0 AND s_nationkey <> 3 GROUP BY s_nationkey HAVING avg(floor(s_acctbal / 100)) > 45)
    ON s_nationkey = n_nationkey""")
def _(star):
    return status_by_place(star.lieferant.filter(~text.same_text("lstadt", "NATION_3")), 45)


@query("a9_having_subquery", """
    WITH je_artikel AS (SELECT anr, avg(lmenge) AS m FROM lieferung GROUP BY anr)
    SELECT anr FROM je_artikel, (SELECT m AS grenze FROM je_artikel WHERE anr = 3) WHERE m < grenze""")
def _(star):
    return below_average_of(star.lieferung, 3)


def below_average_of(deliveries, part):
    limit = deliveries.filter(F.col("anr") == F.lit(part)).agg(F.avg("lmenge")).scalar()
    return deliveries.groupBy("anr").agg(F.avg("lmenge").alias("mittel")).filter(F.col("mittel") < limit).select("anr")


@query("a10_rollup", f"""
    WITH je AS ({MONTHLY})
    SELECT lnr, monat, jahr, CAST(sum(lmenge) AS BIGINT) AS summe, 0 AS ebene FROM je GROUP BY lnr, monat, jahr
    UNION ALL SELECT lnr, monat, NULL, CAST(sum(lmenge) AS BIGINT), 1 FROM je GROUP BY lnr, monat
    UNION ALL SELECT lnr, NULL, NULL, CAST(sum(lmenge) AS BIGINT), 3 FROM je GROUP BY lnr
    UNION ALL SELECT NULL, NULL, NULL, CAST(sum(lmenge) AS BIGINT), 7 FROM je""")
def _(star):
    return grouping.rollup_sum(by_month(star, 10), ["lnr", "monat", "jahr"], "lmenge", "summe")


@query("a11_cube", f"""
    SELECT lnr, monat, jahr, CAST(sum(lmenge) AS BIGINT) AS summe,
           CAST(4 * grouping(lnr) + 2 * grouping(monat) + grouping(jahr) AS INTEGER) AS ebene
    FROM ({MONTHLY}) GROUP BY GROUPING SETS
        ((lnr, monat, jahr), (lnr, monat), (lnr, jahr), (monat, jahr), (lnr), (monat), (jahr), ())""")
def _(star):
    return grouping.cube_sum(by_month(star, 10), ["lnr", "monat", "jahr"], "lmenge", "summe")


@query("a11_cube_month_names", """
    SELECT (['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober',
             'November', 'Dezember'])[month(ldatum)] AS monat, year(ldatum)::INTEGER AS jahr,
           CAST(sum(lmenge) AS BIGINT) AS summe, CAST(grouping_id(month(ldatum), year(ldatum)) AS INTEGER) AS ebene
    FROM lieferung GROUP BY CUBE (month(ldatum), year(ldatum))""")
def _(star):
    named = star.lieferung.select(dates.month_name("ldatum").alias("monat"), F.year("ldatum").alias("jahr"), "lmenge")
    return grouping.cube_sum(named, ["monat", "jahr"], "lmenge", "summe")


@query("a12_first_in_alphabet", "SELECT aname AS erster FROM artikel WHERE aname[1] = 's' ORDER BY aname LIMIT 1")
def _(star):
    return star.artikel.filter(text.like("aname", "s%")).agg(text.first_in_alphabet("aname").alias("erster"))


@query("a14_whole_average", """
    SELECT lnr, CAST(sum(lmenge) AS BIGINT) // count(lmenge) AS ganz, round(avg(lmenge), 6) AS genau
    FROM lieferung GROUP BY lnr""")
def _(star):
    return star.lieferung.groupBy("lnr").agg(
        numbers.whole_average("lmenge").alias("ganz"), F.round(F.avg("lmenge"), 6).alias("genau")
    )


# --- ranks ------------------------------------------------------------------------------------


def supplier_ranks(star):
    totals = star.lieferung.groupBy("lnr").agg(F.sum("lmenge").alias("gesamtliefermenge"))
    return numbering.rank_values(totals, "gesamtliefermenge")


TOTALS = "SELECT lnr, CAST(sum(lmenge) AS BIGINT) AS gesamtliefermenge FROM lieferung GROUP BY lnr"


@query("w1_rank", f"""
    WITH je AS ({TOTALS})
    SELECT lnr, gesamtliefermenge, rank() OVER (ORDER BY gesamtliefermenge DESC) AS rang FROM je""")
def _(star):
    return supplier_ranks(star).drop("rang_dicht")


@query("w2_dense_rank", f"""
    WITH je AS ({TOTALS})
    SELECT lnr, gesamtliefermenge, dense_rank() OVER (ORDER BY gesamtliefermenge DESC) AS rang FROM je""")
def _(star):
    return supplier_ranks(star).drop("rang").withColumnRenamed("rang_dicht", "rang")


@query("w1_part_rank", """
    WITH je AS (SELECT anr, CAST(sum(lmenge) AS BIGINT) AS menge FROM lieferung GROUP BY anr)
    SELECT anr, menge, rank() OVER (ORDER BY menge DESC) AS rang, dense_rank() OVER (ORDER BY menge DESC) AS rang_dicht
    FROM je""")
def _(star):
    totals = star.lieferung.groupBy("anr").agg(F.sum("lmenge").alias("menge"))
    return numbering.rank_values(totals, "menge")


@query("w3_row_number", """
    SELECT lnr, lname, lstadt, row_number() OVER (ORDER BY lname DESC) AS laufende_nummer FROM lieferant""")
def _(star):
    rows = star.lieferant.select("lnr", "lname", "lstadt")
    return numbering.number_rows(rows, [F.col("lname").desc()], "laufende_nummer")


@query("w4_numbered_deliveries", """
    SELECT 999 + row_number() OVER (ORDER BY ldatum, lnr, anr, lmenge) AS nr, lnr, anr, lmenge, ldatum FROM lieferung""")
def _(star):
    order = [F.col(name) for name in ("ldatum", "lnr", "anr", "lmenge")]
    return numbering.number_rows(star.lieferung, order, "nr", start=1000)
