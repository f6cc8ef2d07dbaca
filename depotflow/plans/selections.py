"""Filters, sorting and set operations over the model tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from depotflow.functions import dates, text
from depotflow.operators import numbering, sets
from depotflow.plans import objects
from depotflow.plans.registry import query

DELIVERY = "SELECT lnr, anr, lmenge, ldatum FROM lieferung"


# --- filters ----------------------------------------------------------------------------------


@query("f1_equal_text", """
    SELECT anr, aname, split_part(aname, ' ', 1) AS farbe FROM artikel SEMI JOIN nation
    ON n_name = astadt AND n_nationkey = 3""")
def _(star):
    return star.artikel.filter(text.same_text("astadt", "nation_3")).select("anr", "aname", "farbe")


@query("f1_equal_number", f"{DELIVERY} WHERE lmenge IN (20)")
def _(star):
    return star.lieferung.filter(F.col("lmenge") == 20)


@query("f2_after_date", f"{DELIVERY} WHERE ldatum > TIMESTAMP '2001-08-01'")
def _(star):
    return star.lieferung.filter(dates.after("ldatum", dates.german("01.08.01")))


@query("f2_unequal", f"{DELIVERY} WHERE lmenge <> 20 AND lmenge >= 10 AND lmenge < 40")
def _(star):
    amount = F.col("lmenge")
    return star.lieferung.filter((amount != 20) & (amount >= 10) & (amount < 40))


@query("f3_between_dates", f"{DELIVERY} WHERE ldatum >= TIMESTAMP '1998-07-20' AND ldatum <= TIMESTAMP '1998-08-18'")
def _(star):
    return star.lieferung.filter(dates.between_literals("ldatum", dates.german("20.07.98"), dates.german("18.08.98")))


@query("f3_between_numbers", "SELECT anr, amenge FROM artikel WHERE amenge >= 900 AND amenge <= 1500")
def _(star):
    return star.artikel.filter(F.col("amenge").between(900, 1500)).select("anr", "amenge")


@query("f3_between_text", "SELECT anr, aname FROM artikel WHERE lower(aname) >= 'b' AND lower(aname) <= 'red'")
def _(star):
    return star.artikel.filter(text.text_between("aname", "B", "Red")).select("anr", "aname")


@query("f4_not_between", f"{DELIVERY} WHERE ldatum < TIMESTAMP '1998-07-20' OR ldatum > TIMESTAMP '1998-08-18'")
def _(star):
    first, last = dates.german("20.07.98"), dates.german("18.08.98")
    return star.lieferung.filter(~dates.between_literals("ldatum", first, last))


@query("f5_midnight_bounds", """
    SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06'""")
def _(star):
    return star.raw("events").filter(
        dates.between_literals("ts", datetime(2024, 1, 5), datetime(2024, 1, 6))
    ).select("event_id")


@query("f5_whole_days", """
    SELECT event_id FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')""")
def _(star):
    return star.raw("events").filter(
        dates.through_days("ts", datetime(2024, 1, 5), datetime(2024, 1, 6))
    ).select("event_id")


@query("f6_in_list", "SELECT lnr, lname FROM lieferant WHERE lstadt = 'NATION_3' OR lstadt = 'NATION_7'")
def _(star):
    return star.lieferant.filter(text.text_in("lstadt", "NATION_3", "NATION_7")).select("lnr", "lname")


@query("f7_not_in_list", "SELECT lnr, status FROM lieferant WHERE status <> 20 AND status <> 30 AND status <> 5")
def _(star):
    return star.lieferant.filter(~F.col("status").isin(20, 30, 5)).select("lnr", "status")


@query("f8_like", """
    SELECT anr, aname FROM artikel WHERE starts_with(lower(aname), 's') OR regexp_matches(lower(aname), '^.l.*e.$')""")
def _(star):
    return star.artikel.filter(text.like("aname", "S%") | text.like("aname", "_L%E_")).select("anr", "aname")


@query("f9_like_class", """
    SELECT anr, aname, lower(aname[1]) IN ('b', 'j') AS genau FROM artikel WHERE lower(aname[1]) BETWEEN 'b' AND 'j'""")
def _(star):
    rows = star.artikel.filter(text.like("aname", "[B-J]%"))
    return rows.select("anr", "aname", text.like("aname", "[BJ]%").alias("genau"))


@query("f10_like_other_letter", """
    SELECT doc_id FROM documents WHERE length(replace(replace(text, 'a', ''), 'A', '')) > 0""")
def _(star):
    return star.raw("documents").filter(text.like("text", "%[^a]%")).select("doc_id")


@query("f11_not_like", "SELECT anr, aname FROM artikel WHERE position('a' IN lower(aname)) = 0")
def _(star):
    return star.artikel.filter(~text.like("aname", "%a%")).select("anr", "aname")


@query("f12_like_escape", "SELECT page_id FROM pages WHERE contains(html, '%%')")
def _(star):
    return star.raw("pages").filter(text.like("html", "%y%y%%", escape="y")).select("page_id")


@query("f13_like_mixed", """
    SELECT anr, aname FROM artikel
    WHERE lower(aname[1]) IN ('b', 'c', 's') AND lower(aname[3]) = 'a' AND length(aname) >= 4""")
def _(star):
    return star.artikel.filter(text.like("aname", "[BCS]_a%_")).select("anr", "aname")


HEAVY = "CAST(gewicht AS INTEGER) > 15"


@query("f14_and_before_or", f"""
    SELECT anr FROM artikel
    WHERE CASE WHEN amenge > 1000 THEN TRUE ELSE {HEAVY} AND regexp_matches(aname, '^[e-l]') END""")
def _(star):
    heavy, named = F.col("gewicht") > 15, text.like("aname", "[E-L]%")
    return star.artikel.filter(heavy & named | (F.col("amenge") > 1000)).select("anr")


@query("f14_parentheses", f"""
    SELECT anr FROM artikel
    WHERE {HEAVY} AND CASE WHEN amenge > 1000 THEN TRUE ELSE regexp_matches(aname, '^[e-l]') END""")
def _(star):
    heavy, named = F.col("gewicht") > 15, text.like("aname", "[E-L]%")
    return star.artikel.filter(heavy & (named | (F.col("amenge") > 1000))).select("anr")


@query("f15_unknown", "SELECT lnr, lname FROM lieferant WHERE coalesce(status, -1) = -1")
def _(star):
    return star.lieferant.filter(F.col("status").isNull()).select("lnr", "lname")


@query("f15_known", "SELECT lnr, status FROM lieferant WHERE status >= 0")
def _(star):
    return star.lieferant.filter(F.col("status").isNotNull()).select("lnr", "status")


@query("f15_equals_null", "SELECT lnr FROM lieferant WHERE 1 = 0")
def _(star):
    return star.lieferant.filter(F.col("lstadt") == F.lit(None)).select("lnr")


@query("f16_month", f"{DELIVERY} WHERE strftime(ldatum, '%Y-%m') = '1998-08'")
def _(star):
    return star.lieferung.filter(dates.in_month("ldatum", 1998, 8))


@query("f17_same_day", """
    SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE date_trunc('day', o_orderdate) + to_days(30) = date_trunc('day', l_shipdate)""")
def _(star):
    orders = star.raw("orders").select("o_orderkey", "o_orderdate")
    lines = star.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    due = F.date_add("o_orderdate", 30)
    return orders.join(lines, "o_orderkey").filter(dates.same_day(due, "l_shipdate")).select("o_orderkey")


@query("f18_optional_given", """
    SELECT p_partkey AS anr, p_name AS aname, n_name AS astadt FROM part JOIN nation ON n_nationkey = p_partkey % 20
    WHERE p_name LIKE 'blue %'""")
def _(star):
    return objects.parts_by_colour(star, "Blue")


@query("f18_optional_missing", "SELECT anr, aname, astadt FROM artikel")
def _(star):
    return objects.parts_by_colour(star)


@query("f19_chosen_columns", "SELECT aname, astadt FROM artikel WHERE NOT amenge < 950")
def _(star):
    return objects.chosen_columns(star.artikel, ["aname", "astadt"], "amenge", 950)


# --- sorting ----------------------------------------------------------------------------------


# The place of each row is a column, so that the order itself is compared.
@query("o1_two_keys", """
    SELECT row_number() OVER (ORDER BY lower(aname), lower(astadt) DESC, anr) AS platz, anr, aname, astadt FROM artikel""")
def _(star):
    order = [text.alphabetic("aname").asc(), text.alphabetic("astadt").desc(), F.col("anr")]
    return numbering.number_rows(star.artikel.select("anr", "aname", "astadt"), order, "platz")


@query("o2_alias", """
    SELECT row_number() OVER (ORDER BY anr, astadt DESC) AS platz, anr AS artikelnummer, astadt AS lagerort FROM artikel""")
def _(star):
    renamed = star.artikel.select(F.col("anr").alias("artikelnummer"), F.col("astadt").alias("lagerort"))
    return numbering.number_rows(renamed, [F.asc("artikelnummer"), text.alphabetic("lagerort").desc()], "platz")


@query("o3_position", "SELECT anr, aname, farbe FROM artikel")
def _(star):
    return star.artikel.select("anr", "aname", "farbe").orderBy(2, F.desc("farbe"), 1)


@query("o4_sorted_union", """
    SELECT row_number() OVER (ORDER BY lower(ort) DESC) AS platz, ort
    FROM (SELECT lstadt AS ort FROM lieferant UNION SELECT astadt FROM artikel)""")
def _(star):
    return numbering.number_rows(all_places(star), [text.alphabetic("ort").desc()], "platz")


@query("o5_first", """
    SELECT arg_min(anr, (aname, anr)) AS anr, min(aname) AS aname FROM artikel WHERE aname LIKE 's%'""")
def _(star):
    rows = star.artikel.filter(text.like("aname", "[s]%"))
    return rows.select("anr", "aname").orderBy(text.alphabetic("aname"), "anr").limit(1)


# --- set operations ---------------------------------------------------------------------------


def places(star):
    living = star.lieferant.select(F.col("lstadt").alias("ort"))
    storing = star.artikel.select(F.col("astadt").alias("ort"))
    return living, storing


def all_places(star):
    return sets.union_texts(*places(star), "ort")


@query("u1_union", """
    SELECT n_name AS ort FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) OR n_nationkey IN (SELECT p_partkey % 20 FROM part)""")
def _(star):
    return all_places(star)


@query("u2_union_all", """
    SELECT n_name AS ort FROM nation JOIN (
        SELECT s_nationkey AS k FROM supplier UNION ALL SELECT p_partkey % 20 FROM part) ON k = n_nationkey""")
def _(star):
    living, storing = places(star)
    return living.union(storing)


@query("u3_except", """
    SELECT n_name AS ort FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
      AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey % 20 = n_nationkey)""")
def _(star):
    return sets.except_texts(*places(star), "ort")


@query("u4_intersect", """
    SELECT n_name AS ort FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
      AND EXISTS (SELECT 1 FROM part WHERE p_partkey % 20 = n_nationkey)""")
def _(star):
    return sets.intersect_texts(*places(star), "ort")


def mixed_case_places(star):
    """Places in capitals on one side, in small letters with trailing blanks on the other."""
    living, storing = places(star)
    return living.select(F.upper("ort").alias("ort")), storing.select(F.concat(F.lower("ort"), F.lit("  ")).alias("ort"))


@query("u4_intersect_mixed_case", """
    SELECT upper(n_name) AS ort FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) AND n_nationkey IN (SELECT p_partkey % 20 FROM part)""")
def _(star):
    return sets.intersect_texts(*mixed_case_places(star), "ort")


@query("u3_except_mixed_case", """
    SELECT upper(n_name) AS ort FROM nation
    WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) AND n_nationkey NOT IN (SELECT p_partkey % 20 FROM part)""")
def _(star):
    return sets.except_texts(*mixed_case_places(star), "ort")
