"""The business questions, each a function of the data set and its parameters."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from depotflow.functions import dates, numbers, text
from depotflow.operators import division, joins, membership
from depotflow.plans import joins as joined, objects, selections, summaries
from depotflow.plans.registry import query

RED_BLUE = ("red", "blue")


# --- 1: filters -------------------------------------------------------------------------------


def deliveries_on_two_days(star, first: datetime, how: str) -> DataFrame:
    """Deliveries on a day or the day after it, in three spellings with the same answer."""
    second = first + timedelta(days=1)
    condition = {
        "between": dates.between_literals("ldatum", first, second),
        "in": dates.at("ldatum", first) | dates.at("ldatum", second),
        "compare": dates.since("ldatum", first) & ~dates.after("ldatum", second),
    }[how]
    return star.lieferung.filter(condition)


TWO_DAYS = "SELECT lnr, anr, lmenge, ldatum FROM lieferung WHERE CAST(ldatum AS DATE) - DATE '1998-08-05' IN (0, 1)"

for _how in ("between", "in", "compare"):
    query(f"e1_1_two_days_{_how}", TWO_DAYS)(
        lambda star, how=_how: deliveries_on_two_days(star, datetime(1998, 8, 5), how)
    )


def coloured_or_stocked(star, place, colours, low, high) -> DataFrame:
    """Parts of some colours at a place, and parts with an ``a`` in the name and a stock in bounds."""
    coloured = text.text_in("farbe", *colours) & text.same_text("astadt", place)
    stocked = F.col("amenge").between(low, high) & text.like("aname", "%a%")
    return star.artikel.filter(coloured | stocked).select("anr", "aname")


@query("e1_2_coloured_or_stocked", """
    SELECT anr, aname FROM artikel WHERE astadt = 'NATION_3' AND farbe IN ('red', 'blue')
    UNION SELECT anr, aname FROM artikel WHERE contains(aname, 'a') AND amenge BETWEEN 1050 AND 1500""")
def _(star):
    return coloured_or_stocked(star, "NATION_3", RED_BLUE, 1050, 1500)


@query("e1_3_names_between", "SELECT anr, aname FROM artikel WHERE aname <= 'g'")
def _(star):
    return star.artikel.filter(text.text_between("aname", "A", "G")).select("anr", "aname")


@query("e1_3_names_class", "SELECT anr, aname FROM artikel WHERE ascii(aname) BETWEEN 97 AND 103")
def _(star):
    return star.artikel.filter(text.like("aname", "[a-g]%")).select("anr", "aname")


def named_and_not_living(suppliers, pattern, unwanted, name="lname", place="lstadt") -> DataFrame:
    """Rows whose name fits a pattern and whose place is known and does not hold a text."""
    return suppliers.filter(text.like(name, pattern) & ~text.like(place, f"%{unwanted}%"))


@query("e1_4_named_not_living", """
    SELECT anr, aname, astadt FROM artikel
    WHERE substr(aname, 1, 1) IN ('b', 'c', 's') AND substr(aname, 3, 1) = 'a' AND position('_1' IN astadt) = 0""")
def _(star):
    rows = star.artikel.select("anr", "aname", "astadt")
    return named_and_not_living(rows, "[BCS]_a%_", "ION[_]1", "aname", "astadt")


def weight_zero_or_unknown(parts) -> DataFrame:
    return parts.filter(F.coalesce(F.col("gewicht"), F.lit(0)) == 0)


@query("e1_5_weight_zero_or_unknown", """
    SELECT lnr, status AS gewicht FROM lieferant WHERE status IS NULL OR status < 1""")
def _(star):
    return weight_zero_or_unknown(star.lieferant.select("lnr", F.col("status").alias("gewicht")))


# --- 3: aggregates ----------------------------------------------------------------------------


def count_in_month(star, month: int) -> DataFrame:
    return star.lieferung.filter(F.month("ldatum") == month).agg(F.count("lnr").alias("anzahl"))


@query("e3_1_august_deliveries", "SELECT count(*) AS anzahl FROM lineitem WHERE strftime(l_shipdate, '%m') = '08'")
def _(star):
    return count_in_month(star, 8)


@query("e3_2_known_values", "SELECT count(*) AS anzahl FROM supplier WHERE s_acctbal >= 0")
def _(star):
    return star.lieferant.agg(F.count("status").alias("anzahl"))


@query("e3_3_smallest_delivery", "SELECT DISTINCT lnr, min(lmenge) OVER (PARTITION BY lnr) AS kleinste FROM lieferung")
def _(star):
    return star.lieferung.groupBy("lnr").agg(F.min("lmenge").alias("kleinste"))


@query("e3_4_first_named", "SELECT min(aname) AS erster FROM artikel WHERE starts_with(aname, 's')")
def _(star):
    return star.artikel.filter(text.like("aname", "s%")).agg(text.first_in_alphabet("aname").alias("erster"))


@query("e3_5_highest_stock", "SELECT DISTINCT astadt, max(amenge) OVER (PARTITION BY astadt) AS hoechster FROM artikel")
def _(star):
    return star.artikel.groupBy("astadt").agg(F.max("amenge").alias("hoechster"))


@query("e3_6_distinct_parts", """
    SELECT lnr, count(*) AS artikel FROM (SELECT DISTINCT lnr, anr FROM lieferung) GROUP BY lnr""")
def distinct_parts(star):
    return star.lieferung.groupBy("lnr").agg(F.countDistinct("anr").alias("artikel"))


def rarely_delivered(star, fewer_than: int) -> DataFrame:
    counts = star.lieferung.groupBy("anr").agg(F.count("anr").alias("anzahl"))
    return counts.filter(F.col("anzahl") < fewer_than).select("anr")


@query("e3_7_rarely_delivered", """
    SELECT l_partkey AS anr FROM lineitem GROUP BY l_partkey EXCEPT
    SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) >= 25""")
def _(star):
    return rarely_delivered(star, 25)


def large_suppliers_since(star, moment: datetime, more_than: int) -> DataFrame:
    totals = star.lieferung.filter(dates.since("ldatum", moment)).groupBy("lnr").agg(F.sum("lmenge").alias("menge"))
    return totals.filter(F.col("menge") > more_than)


@query("e3_8_large_suppliers", """
    SELECT lnr, CAST(menge AS BIGINT) AS menge FROM (
        SELECT lnr, sum(CASE WHEN ldatum < TIMESTAMP '1998-07-13' THEN 0 ELSE lmenge END) AS menge
        FROM lieferung GROUP BY lnr)
    WHERE menge > 7500""")
def _(star):
    return large_suppliers_since(star, datetime(1998, 7, 13), 7500)


def status_bounds(suppliers, above: int, up_to: int) -> DataFrame:
    bounds = suppliers.groupBy("lstadt").agg(F.min("status").alias("kleinster"), F.max("status").alias("groesster"))
    return bounds.filter((F.col("kleinster") > above) & (F.col("groesster") <= up_to))


@query("e3_9_status_bounds", """
    WITH je AS (SELECT lstadt, list_sort(list(status) FILTER (status IS NOT NULL)) AS w FROM lieferant
                GROUP BY lstadt)
    SELECT lstadt, w[1] AS kleinster, w[-1] AS groesster FROM je WHERE w[1] > 10 AND w[-1] <= 90""")
def _(star):
    return status_bounds(star.lieferant, 10, 90)


# --- 4: subqueries ----------------------------------------------------------------------------


@query("e4_0a_living_where_stored", """
    SELECT s.lnr, s.lname, s.lstadt FROM artikel p, lieferant s WHERE p.anr = 7 AND p.astadt = s.lstadt""")
def _(star):
    return joined.suppliers_where_stored(star, 7)


@query("e4_0b_delivered_parts", "SELECT p_partkey AS anr, p_name AS aname FROM part SEMI JOIN lineitem ON l_partkey = p_partkey")
def delivered_parts(star):
    return membership.only_in(star.only("artikel", "anr", "aname"), star.lieferung, "anr")


@query("e4_0c_coloured_deliverers", """
    SELECT s.lnr, s.lname, s.status, s.lstadt FROM lieferant s SEMI JOIN (
        SELECT d.lnr FROM lieferung d JOIN artikel a ON a.anr = d.anr
        WHERE (farbe = 'red' OR farbe = 'blue') AND d.ldatum > TIMESTAMP '2001-09-01') d ON d.lnr = s.lnr
    WHERE s.lstadt = 'NATION_7'""")
def _(star):
    return joined.coloured_deliverers(star, "NATION_7", RED_BLUE, datetime(2001, 9, 1))


def above_average_of_city(star, number) -> DataFrame:
    """Suppliers whose status is above the average at the place of one supplier."""
    place = star.lieferant.filter(F.col("lnr") == F.lit(number)).select("lstadt").scalar()
    average = star.lieferant.filter(F.col("lstadt") == place).agg(F.avg("status")).scalar()
    return star.lieferant.filter(F.col("status") > average)


@query("e4_1_above_city_average", """
    WITH je_ort AS (SELECT lstadt, avg(status) AS mittel FROM lieferant GROUP BY lstadt),
         grenze AS (SELECT mittel FROM lieferant JOIN je_ort USING (lstadt) WHERE lnr = 2)
    SELECT lnr, lname, status, lstadt FROM lieferant, grenze WHERE status > mittel""")
def _(star):
    return above_average_of_city(star, 2)


def parts_of_busy_suppliers(star, year: int, month: int, at_least: int) -> DataFrame:
    """Parts that were delivered in a month by suppliers with at least so many deliveries in all.

    The counts are taken per supplier before any join; the month reaches the scan as a date range.
    """
    busy = star.lieferung.groupBy("lnr").agg(F.count("lnr").alias("anzahl")).filter(F.col("anzahl") >= at_least)
    return membership.in_cascade(
        star.only("artikel", "anr", "aname"),
        membership.Level(star.lieferung.filter(dates.in_month("ldatum", year, month)), "anr"),
        membership.Level(busy, "lnr", unique=True, measured=True),
    )


@query("e4_2_parts_of_busy_suppliers", """
    SELECT DISTINCT p_partkey AS anr, p_name AS aname FROM (
        SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS anzahl FROM lineitem) l
    JOIN part ON p_partkey = l.l_partkey
    WHERE anzahl >= 600 AND year(l_shipdate) = 1998 AND month(l_shipdate) = 8""")
def _(star):
    return parts_of_busy_suppliers(star, 1998, 8, 600)


@query("e4_3_coloured_dates", """
    SELECT strftime(ldatum, '%d.%m.%Y') AS lieferdatum FROM lieferung
    SEMI JOIN (SELECT lnr FROM lieferant WHERE lstadt = 'NATION_7') USING (lnr)
    SEMI JOIN (SELECT anr FROM artikel WHERE farbe IN ('red', 'blue')) USING (anr)""")
def _(star):
    rows = joined.coloured_deliveries(star, "NATION_7", RED_BLUE)
    return rows.select(dates.german_text("ldatum").alias("lieferdatum"))


def last_delivered_with(star, number) -> DataFrame:
    """Parts whose last delivery has the date of another part's last delivery."""
    last = star.lieferung.filter(F.col("anr") == F.lit(number)).agg(F.max("ldatum")).scalar()
    latest = star.lieferung.groupBy("anr").agg(F.max("ldatum").alias("letzte")).filter(F.col("letzte") == last)
    return star.only("artikel", "anr", "aname").join(latest, "anr", "left_semi")


@query("e4_4_same_last_day", """
    WITH letzte AS (SELECT anr, aname, max(ldatum) AS am FROM lieferung JOIN artikel USING (anr) GROUP BY ALL)
    SELECT a.anr, a.aname FROM letzte a JOIN letzte b ON a.am = b.am WHERE b.anr = 2""")
def _(star):
    return last_delivered_with(star, 2)


def suppliers_of_every_part(star) -> DataFrame:
    """Suppliers with as many different parts as there are."""
    complete = division.with_every(star.lieferung, "lnr", "anr", star.artikel)
    return star.only("lieferant", "lnr", "lname").join(complete, "lnr", "left_semi")


EVERY_PART = """
    SELECT lnr, lname FROM lieferant
    WHERE list_unique((SELECT list(anr) FROM lieferung d WHERE d.lnr = lieferant.lnr)) = (SELECT count(*) FROM part)"""


@query("e4_5_suppliers_of_every_part", EVERY_PART)
def _(star):
    return suppliers_of_every_part(star)


def repeated_parts_of_busy_suppliers(star, times: int, more_than: int) -> DataFrame:
    """Parts delivered so many times by suppliers with more than so many deliveries."""
    busy = star.lieferung.groupBy("lnr").agg(F.count("lnr").alias("anzahl")).filter(F.col("anzahl") > more_than)
    theirs = membership.only_in(star.lieferung, busy, "lnr", unique=True, measured=True)
    repeated = theirs.groupBy("anr").agg(F.count("anr").alias("mal")).filter(F.col("mal") >= times)
    return star.only("artikel", "anr", "aname").join(repeated, "anr", "left_semi")


@query("e4_6_repeated_parts", """
    WITH gross AS (SELECT lnr FROM lieferung GROUP BY lnr HAVING count(*) > 610),
         mal AS (SELECT anr, count(*) AS n FROM lieferung NATURAL JOIN gross GROUP BY anr)
    SELECT anr, aname FROM artikel NATURAL JOIN mal WHERE n >= 12""")
def _(star):
    return repeated_parts_of_busy_suppliers(star, 12, 610)


@query("e4_7_weight_deviation", """
    WITH m AS (SELECT sum(gewicht) / count(gewicht) AS mittel FROM artikel)
    SELECT anr, aname, gewicht, round(gewicht - mittel, 6) AS abweichung FROM artikel, m""")
def weight_deviation(star):
    mean = star.artikel.agg(F.avg(F.col("gewicht").cast("double"))).scalar()
    deviation = F.round(F.col("gewicht").cast("double") - mean, 6)
    return star.artikel.select("anr", "aname", "gewicht", deviation.alias("abweichung"))


@query("e4_8_frequent_suppliers", """
    WITH je AS (SELECT lnr, count(*) AS n FROM lieferung GROUP BY lnr)
    SELECT lnr, lname, status, lstadt FROM lieferant NATURAL JOIN je WHERE n >= 620""")
def _(star):
    return joined.frequent_suppliers(star, 620)


def that_delivered(star, deliveries, how: str) -> DataFrame:
    """Suppliers with deliveries, in three spellings with the same answer."""
    if how == "exists":
        rows = membership.where_exists(star.lieferant, deliveries, "lnr")
    elif how == "in":
        rows = membership.only_in(star.lieferant, deliveries, "lnr")
    else:
        rows = star.lieferant.join(deliveries.select("lnr").distinct(), "lnr")
    return rows.select("lnr", "lname", "status", "lstadt")


for _how in ("exists", "in", "join"):
    query(f"e4_9_that_delivered_{_how}", f"""
        SELECT lnr, lname, status, lstadt FROM lieferant SEMI JOIN lieferung USING (lnr)""")(
        lambda star, how=_how: that_delivered(star, star.lieferung, how)
    )


# --- 5: joins and more ------------------------------------------------------------------------


@query("e5_1_suppliers_of_city", "FROM lieferant SELECT lnr, lname, status, lstadt WHERE lower(lstadt) = 'nation_11'")
def _(star):
    return star.lieferant.filter(objects.at_place("NATION_11"))


@query("e5_2_delivered_places", """
    SELECT anr, any_value(aname) AS aname, any_value(astadt) AS astadt FROM artikel JOIN lieferung USING (anr) GROUP BY anr""")
def _(star):
    return membership.only_in(star.artikel, star.lieferung, "anr").select("anr", "aname", "astadt")


@query("e5_3_weight_in_kilos", "SELECT p_partkey AS anr, p_name AS aname, round(p_size / 1000, 3) AS kg FROM part")
def _(star):
    return star.artikel.select("anr", "aname", numbers.kilograms("gewicht").alias("kg"))


@query("e5_4_city_and_status", "SELECT lname FROM lieferant WHERE (lstadt, status // 41) = ('NATION_11', 1)")
def _(star):
    return star.lieferant.filter(objects.at_place("NATION_11") & F.col("status").between(41, 81)).select("lname")


@query("e5_5_three_weights", "SELECT p_partkey AS anr, p_name AS aname FROM part WHERE list_contains([12, 14, 17], p_size)")
def _(star):
    return star.artikel.filter(F.col("gewicht").isin(12, 14, 17)).select("anr", "aname")


@query("e5_6_deliveries_from_city", """
    SELECT d.lnr, d.anr, d.lmenge, d.ldatum FROM lieferung d JOIN lieferant s ON s.lnr = d.lnr AND s.lstadt = 'NATION_3'""")
def _(star):
    return membership.only_in(star.lieferung, star.lieferant.filter(objects.at_place("NATION_3")), "lnr", unique=True)


@query("e5_7_same_place", """
    SELECT anr, aname, astadt, (SELECT count(*) FROM lieferant WHERE lstadt = astadt) AS lieferanten
    FROM artikel WHERE astadt IN (SELECT lstadt FROM lieferant)""")
def _(star):
    return joined.same_place(star)


@query("e5_8_same_place_delivered", """
    SELECT a.anr, a.aname, a.astadt, s.lnr, s.lname, s.lstadt
    FROM (SELECT anr, lnr FROM lieferung GROUP BY ALL) d JOIN artikel a ON a.anr = d.anr
    JOIN lieferant s ON s.lnr = d.lnr AND s.lstadt = a.astadt""")
def _(star):
    return joined.delivered_where_stored(star)


@query("e5_9_part_pairs", """
    SELECT a.astadt, a.anr, (SELECT count(*) FROM artikel c WHERE c.astadt = a.astadt AND c.anr <= a.anr) AS position,
           count(b.anr) AS partner
    FROM artikel a LEFT JOIN artikel b ON a.astadt = b.astadt AND a.anr < b.anr GROUP BY a.astadt, a.anr""")
def _(star):
    return joins.partners_by_group(star.artikel.select("astadt", "anr"), "astadt", "anr")


def sharing_a_part_with(star, number) -> DataFrame:
    theirs = star.lieferung.filter(F.col("lnr") == F.lit(number))
    shared = membership.only_in(star.lieferung.select("lnr", "anr"), theirs, "anr", measured=True)
    return shared.filter(F.col("lnr") != F.lit(number)).select("lnr").distinct()


@query("e5_10_sharing_a_part", """
    SELECT DISTINCT a.lnr FROM lieferung a, (SELECT DISTINCT anr FROM lieferung WHERE lnr = 3) b
    WHERE a.anr = b.anr AND a.lnr <> 3""")
def _(star):
    return sharing_a_part_with(star, 3)


@query("e5_11_several_parts", "SELECT lnr FROM lieferung GROUP BY lnr HAVING min(anr) < max(anr)")
def several_parts(star):
    # More than one part means that the smallest and the largest number differ; nothing is counted.
    ends = star.lieferung.groupBy("lnr").agg(F.min("anr").alias("von"), F.max("anr").alias("bis"))
    return ends.filter(F.col("von") < F.col("bis")).select("lnr")


@query("e5_12_stored_with", """
    SELECT anr, aname FROM (SELECT *, bool_or(anr = 5) OVER (PARTITION BY astadt) AS hier FROM artikel)
    WHERE hier AND anr <> 5""")
def _(star):
    return joined.stored_with(star, 5)


@query("e5_13_average_quantity", """
    SELECT round(sum(l_quantity) / count(l_quantity), 6) AS mittel FROM lineitem WHERE l_partkey = 1""")
def _(star):
    return star.lieferung.filter(F.col("anr") == 1).agg(F.round(F.avg("lmenge"), 6).alias("mittel"))


@query("e5_14_total_quantity", """
    SELECT CAST(sum(l_quantity) AS BIGINT) AS menge FROM lineitem WHERE l_suppkey = 2 AND l_partkey = 1172""")
def _(star):
    rows = star.lieferung.filter((F.col("anr") == 1172) & (F.col("lnr") == 2))
    return rows.agg(F.sum("lmenge").alias("menge"))


@query("e5_15_places_of_parts", "SELECT a.astadt FROM lieferung d JOIN artikel a ON a.anr = d.anr AND d.lnr = 2")
def places_of_parts(star, number=2):
    return star.artikel.join(star.lieferung.filter(F.col("lnr") == F.lit(number)), "anr").select("astadt")


def status_below(star, number) -> DataFrame:
    limit = star.lieferant.filter(F.col("lnr") == F.lit(number)).select("status").scalar()
    return star.lieferant.filter(F.col("status") < limit).select("lnr", "lname")


@query("e5_16_status_below", "SELECT a.lnr, a.lname FROM lieferant a JOIN lieferant b ON b.lnr = 3 AND a.status < b.status")
def _(star):
    return status_below(star, 3)


@query("e5_17_covering_suppliers", """
    WITH paare AS (SELECT DISTINCT lnr, anr FROM lieferung)
    SELECT x.lnr FROM paare x JOIN paare y ON y.anr = x.anr AND y.lnr = 4 AND x.lnr <> 4
    GROUP BY x.lnr HAVING count(*) = (SELECT count(*) FROM paare WHERE lnr = 4)""")
def _(star):
    return division.covers_all_of(star.lieferung, "lnr", "anr", 4)


@query("e5_18_all_places", "SELECT lstadt AS ort FROM lieferant GROUP BY 1 UNION SELECT astadt FROM artikel GROUP BY 1")
def _(star):
    return selections.all_places(star)


def not_delivering(star, number) -> DataFrame:
    """``lnr`` is declared not null, so the negated IN is a plain anti-join."""
    theirs = star.lieferung.filter(F.col("anr") == F.lit(number))
    return membership.not_matched(star.lieferant, theirs, "lnr").select("lnr", "lname")


@query("e5_19_not_delivering", """
    SELECT lnr, lname FROM lieferant ANTI JOIN (SELECT lnr FROM lieferung WHERE anr = 9) USING (lnr)""")
def _(star):
    return not_delivering(star, 9)


@query("e5_20_suppliers_of_all_parts", EVERY_PART)
def _(star):
    return suppliers_of_every_part(star)


@query("e5_20_suppliers_of_all_colours", """
    SELECT lnr, any_value(lname) AS lname FROM lieferung JOIN artikel USING (anr) JOIN lieferant USING (lnr) GROUP BY lnr
    HAVING list_unique(list(farbe)) = (SELECT count(DISTINCT farbe) FROM artikel)""")
def _(star):
    pairs = star.lieferung.join(star.artikel.select("anr", "farbe"), "anr")
    complete = division.divide(pairs, "lnr", "farbe", star.artikel)
    return star.only("lieferant", "lnr", "lname").join(complete, "lnr", "left_semi")


def above_lowest_status(star) -> DataFrame:
    lowest = star.lieferant.agg(F.min("status")).scalar()
    rows = membership.only_in(star.lieferant.filter(F.col("status") > lowest), star.lieferung, "lnr")
    return rows.select("lnr", "lname", "lstadt")


@query("e5_21_above_lowest_status", """
    SELECT lnr, lname, lstadt FROM (SELECT *, rank() OVER (ORDER BY status NULLS LAST) AS r FROM lieferant)
    WHERE r > 1 AND status IS NOT NULL AND lnr IN (SELECT lnr FROM lieferung)""")
def _(star):
    return above_lowest_status(star)


@query("e5_22_below_average_of", """
    WITH m AS (SELECT anr, sum(lmenge) / count(*) AS mittel FROM lieferung GROUP BY anr)
    SELECT a.anr, a.aname FROM artikel a JOIN m ON m.anr = a.anr JOIN m g ON g.anr = 6 WHERE m.mittel < g.mittel""")
def _(star):
    low = summaries.below_average_of(star.lieferung, 6)
    return star.only("artikel", "anr", "aname").join(low, "anr")


def city_deliveries_since(star, place: str, moment: datetime) -> DataFrame:
    return (
        star.lieferung.filter(dates.since("ldatum", moment))
        .join(star.lieferant.filter(objects.at_place(place)), "lnr")
        .join(star.artikel, "anr")
        .select("lnr", "lname", "anr", "aname")
    )


CITY_SINCE = """FROM lieferant s JOIN lieferung d ON d.lnr = s.lnr JOIN artikel a ON a.anr = d.anr
                WHERE s.lstadt = 'NATION_15' AND d.ldatum >= TIMESTAMP '2001-05-05'"""


@query("e5_23_city_deliveries", f"SELECT s.lnr, s.lname, a.anr, a.aname {CITY_SINCE}")
def _(star):
    return city_deliveries_since(star, "NATION_15", datetime(2001, 5, 5))


def count_city_deliveries_since(star, place: str, moment: datetime) -> DataFrame:
    rows = star.lieferung.filter(dates.since("ldatum", moment))
    local = star.lieferant.filter(objects.at_place(place))
    return rows.join(local, "lnr", "left_semi").agg(F.count("*").alias("anzahl"))


@query("e5_24_city_delivery_count", f"SELECT count(*) AS anzahl {CITY_SINCE}")
def _(star):
    return count_city_deliveries_since(star, "NATION_15", datetime(2001, 5, 5))


def living_places(star) -> DataFrame:
    return star.lieferant.select("lstadt").distinct()


@query("e5_25_only_living", """
    SELECT lstadt FROM lieferant GROUP BY lstadt EXCEPT SELECT astadt FROM artikel""")
def _(star):
    return membership.not_in(living_places(star), "lstadt", star.artikel, "astadt")


@query("e5_26_living_and_storing", "SELECT DISTINCT lstadt FROM lieferant JOIN artikel ON astadt = lstadt")
def _(star):
    storing = star.artikel.select(F.col("astadt").alias("lstadt"))
    return membership.only_in(living_places(star), storing, "lstadt")
