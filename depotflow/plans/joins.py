"""Joins and subqueries over the model tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from depotflow.functions import dates, text
from depotflow.operators import division, joins, membership
from depotflow.plans import objects
from depotflow.plans.registry import query

JOINED = "SELECT lnr, lname, status, lstadt, anr, lmenge, ldatum FROM lieferant"


# Beside the model: customers and their events, of which most customers have none.
def customers(star):
    return star.raw("customer").select(F.col("c_custkey").alias("kunde"), F.col("c_name").alias("kname"))


def events(star):
    return star.raw("events").select(F.col("user_id").alias("kunde"), F.col("event_type").alias("art"), "value")


CUSTOMERS = "SELECT c_custkey AS kunde, c_name AS kname FROM customer"


@query("j1_product_size", """
    SELECT CAST((SELECT count(*) FROM supplier) * (SELECT count(*) FROM lineitem) AS DOUBLE) AS zwei,
           CAST((SELECT count(*) FROM supplier) * (SELECT count(*) FROM lineitem) AS DOUBLE)
               * (SELECT count(*) FROM part) AS drei""")
def _(star):
    return star.spark.range(1).select(
        membership.product_size(star.lieferant, star.lieferung).alias("zwei"),
        membership.product_size(star.lieferant, star.lieferung, star.artikel).alias("drei"),
    )


@query("j2_inner", """
    SELECT s.lnr, s.lname, s.status, s.lstadt, d.lnr AS lieferung_lnr, d.anr, d.lmenge, d.ldatum
    FROM lieferung d JOIN lieferant s ON d.lnr = s.lnr""")
def _(star):
    deliveries = star.lieferung.withColumnRenamed("lnr", "lieferung_lnr")
    return star.lieferant.join(deliveries, F.col("lnr") == F.col("lieferung_lnr"))


@query("j3_natural", f"{JOINED} NATURAL JOIN lieferung")
def _(star):
    return objects.deliveries_with_supplier(star)


@query("j4_filtered", f"""
    {JOINED} JOIN lieferung USING (lnr)
    WHERE lstadt = 'NATION_3' AND date_trunc('month', ldatum) = DATE '1998-08-01'""")
def _(star):
    rows = objects.deliveries_with_supplier(star)
    return rows.filter(objects.at_place("NATION_3") & dates.in_month("ldatum", 1998, 8))


@query("j5_where_join", """
    SELECT lnr, anr, aname FROM lieferung JOIN artikel USING (anr) WHERE lnr = 2""")
def _(star):
    chosen = star.lieferung.filter(F.col("lnr") == 2)
    return star.artikel.join(chosen, "anr").select("lnr", "anr", "aname")


@query("j6_three_way", """
    SELECT d.anr, aname, ldatum FROM lieferant s JOIN lieferung d USING (lnr) JOIN artikel a ON a.anr = d.anr
    WHERE farbe = ANY (['red', 'blue']) AND lstadt = 'NATION_7'""")
def _(star):
    return (
        star.lieferung.join(star.artikel.filter(text.text_in("farbe", "red", "blue")), "anr")
        .join(star.lieferant.filter(objects.at_place("NATION_7")), "lnr")
        .select("anr", "aname", "ldatum")
    )


def that_delivered(star, deliveries):
    return membership.only_in(star.lieferant, deliveries, "lnr").select("lnr", "lname")


@query("j7_distinct_as_semi_join", """
    SELECT lnr, any_value(lname) AS lname FROM lieferant JOIN lieferung USING (lnr) GROUP BY lnr""")
def _(star):
    return that_delivered(star, star.lieferung)


@query("j7_customers_with_events", f"{CUSTOMERS} WHERE c_custkey IN (SELECT user_id FROM events)")
def _(star):
    return membership.only_in(customers(star), events(star), "kunde")


@query("j8_joined_aggregate", """
    SELECT DISTINCT lnr, lname, count(*) OVER (PARTITION BY lnr) AS anz FROM lieferant JOIN lieferung USING (lnr)
    QUALIFY count(*) OVER (PARTITION BY lnr) >= 600""")
def _(star):
    counts = star.lieferung.groupBy("lnr").agg(F.count("*").alias("anz")).filter("anz >= 600")
    return star.lieferant.join(counts, "lnr").select("lnr", "lname", "anz")


@query("j9_left_outer", f"{JOINED} LEFT JOIN lieferung USING (lnr)")
def _(star):
    return joins.left_from_dimension(star.lieferant, star.lieferung, "lnr")


@query("j9_customers_and_events", f"""
    SELECT kunde, kname, event_type AS art, value FROM ({CUSTOMERS}) LEFT JOIN events ON user_id = kunde""")
def _(star):
    return joins.left_from_dimension(customers(star), events(star), "kunde")


@query("j10_right_outer", """
    SELECT d.lnr, lname, status, lstadt, anr, lmenge, ldatum FROM lieferung d LEFT JOIN lieferant s ON s.lnr = d.lnr""")
def _(star):
    return star.lieferant.join(star.lieferung, "lnr", "right")


def documents(star):
    return star.raw("documents").select("doc_id", "lang", "source")


@query("j10_labels_of_documents", """
    SELECT doc_id, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def _(star):
    return star.raw("labels").join(documents(star), "doc_id", "right").select(
        "doc_id", "lang", "source", "quality", "toxic")


@query("j11_full_outer", f"{JOINED} FULL JOIN lieferung USING (lnr)")
def _(star):
    return joins.full_outer(star.lieferant, star.lieferung, "lnr")


@query("j11_parts_and_customers", """
    SELECT coalesce(p_partkey, c_custkey) AS nummer, p_name AS aname, c_name AS kname
    FROM part FULL JOIN customer ON c_custkey = p_partkey""")
def _(star):
    parts = star.raw("part").select(F.col("p_partkey").alias("nummer"), F.col("p_name").alias("aname"))
    buyers = star.raw("customer").select(F.col("c_custkey").alias("nummer"), F.col("c_name").alias("kname"))
    return joins.full_outer(parts, buyers, "nummer")


@query("j12_anti_join", """
    SELECT lnr, lname FROM lieferant EXCEPT SELECT lnr, lname FROM lieferant JOIN lieferung USING (lnr)""")
def _(star):
    return membership.not_matched(star.lieferant, star.lieferung, "lnr").select("lnr", "lname")


@query("j12_customers_without_events", f"{CUSTOMERS} ANTI JOIN events ON user_id = c_custkey")
def _(star):
    return membership.not_matched(customers(star), events(star), "kunde")


@query("j13_unequal_join", """
    SELECT lnr, (SELECT count(*) FROM lieferung) - (SELECT count(*) FROM lieferung d WHERE d.lnr = s.lnr)
        AS fremde_lieferungen FROM lieferant s""")
def _(star):
    counted = membership.count_unequal(star.lieferant.select("lnr"), star.lieferung, "lnr", "fremde_lieferungen")
    return counted.filter("fremde_lieferungen > 0")


@query("j14_same_place", """
    SELECT anr, aname, astadt, count(*) AS lieferanten FROM artikel JOIN lieferant ON lstadt = astadt GROUP BY ALL""")
def _(star):
    return same_place(star)


def same_place(star):
    parts = star.artikel.select("anr", "aname", "astadt")
    return joins.count_partners(parts, star.lieferant, "astadt", "lstadt", "lieferanten")


def mixed_case(rows, column, number):
    """Texts in capitals with a trailing blank for every second row."""
    spelled = F.when(F.col(number) % 2 == 0, F.concat(F.upper(column), F.lit(" "))).otherwise(F.lower(column))
    return rows.withColumn(column, spelled)


@query("j14_same_place_mixed_case", """
    SELECT anr, CASE WHEN anr % 2 = 0 THEN upper(astadt) || ' ' ELSE lower(astadt) END AS astadt, count(*) AS lieferanten
    FROM artikel JOIN lieferant ON lstadt = astadt GROUP BY anr, artikel.astadt""")
def _(star):
    parts = mixed_case(star.artikel.select("anr", "astadt"), "astadt", "anr")
    return joins.count_partners(parts, mixed_case(star.lieferant, "lstadt", "lnr"), "astadt", "lstadt", "lieferanten")


@query("j15_pairs", """
    SELECT astadt, anr, row_number() OVER w AS position, count(*) OVER (PARTITION BY astadt) - row_number() OVER w AS partner
    FROM artikel WINDOW w AS (PARTITION BY astadt ORDER BY anr)""")
def _(star):
    return joins.partners_by_group(star.artikel.select("astadt", "anr"), "astadt", "anr")


def delivered_where_stored(star):
    """Each part with each supplier that delivered it, where both are at one place."""
    pairs = star.lieferung.select("anr", "lnr").distinct()
    return (
        pairs.join(star.artikel.select("anr", "aname", "astadt"), "anr")
        .join(star.lieferant.select("lnr", "lname", "lstadt"), "lnr")
        .filter(F.col("astadt") == F.col("lstadt"))
        .select("anr", "aname", "astadt", "lnr", "lname", "lstadt")
    )


SAME_PLACE_DELIVERED = """
    SELECT DISTINCT anr, aname, astadt, lnr, lname, lstadt
    FROM lieferung JOIN artikel USING (anr) JOIN lieferant USING (lnr) WHERE lstadt = astadt"""


@query("j16_composite_key", SAME_PLACE_DELIVERED)
def _(star):
    return delivered_where_stored(star)


@query("j17_in_subquery", "SELECT DISTINCT anr, aname FROM artikel JOIN lieferung USING (anr)")
def _(star):
    return membership.only_in(star.artikel, star.lieferung, "anr").select("anr", "aname")


@query("j18_nested_in", """
    SELECT DISTINCT s.lnr, lname FROM lieferant s JOIN lieferung d ON s.lnr = d.lnr JOIN artikel a ON a.anr = d.anr
    WHERE farbe IN ('red', 'blue') AND lstadt = 'NATION_3' AND ldatum > TIMESTAMP '2001-08-01'""")
def _(star):
    return coloured_deliverers(star, "NATION_3", ("red", "blue"), datetime(2001, 8, 1)).select("lnr", "lname")


def coloured_deliverers(star, place, colours, moment):
    return membership.in_cascade(
        star.lieferant.filter(objects.at_place(place)),
        membership.Level(star.lieferung.filter(dates.after("ldatum", moment)), "lnr"),
        membership.Level(star.artikel.filter(text.text_in("farbe", *colours)), "anr", unique=True),
    )


@query("j19_not_in", """
    SELECT lnr, lname FROM lieferant EXCEPT ALL
    SELECT lnr, lname FROM lieferant WHERE EXISTS (FROM lieferung d WHERE d.lnr = lieferant.lnr AND anr = 5)""")
def _(star):
    listed = star.lieferung.filter(F.col("anr") == 5)
    return membership.not_in(star.lieferant, "lnr", listed, "lnr").select("lnr", "lname")


@query("j19_not_in_with_null", "SELECT p_partkey AS anr FROM part WHERE p_size NOT IN (SELECT status FROM lieferant)")
def _(star):
    rows = star.artikel.select("anr", F.col("gewicht").cast("int").alias("groesse"))
    return membership.not_in(rows, "groesse", star.lieferant, "status").select("anr")


@query("j20_scalar_subquery", """
    SELECT lnr, lname, lstadt FROM lieferant JOIN artikel ON astadt = lstadt AND anr = 4""")
def _(star):
    return suppliers_where_stored(star, 4)


def suppliers_where_stored(star, part):
    place = star.artikel.filter(F.col("anr") == F.lit(part)).select(text.comparable(star.artikel, "astadt")).scalar()
    return star.lieferant.filter(text.comparable(star.lieferant, "lstadt") == place).select("lnr", "lname", "lstadt")


@query("j21_correlated_count", """
    SELECT lnr, lname, status, lstadt FROM lieferant s
    WHERE (SELECT count(*) FROM lieferung d WHERE d.lnr = s.lnr) >= 600""")
def _(star):
    return frequent_suppliers(star, 600)


def frequent_suppliers(star, at_least):
    counts = star.lieferung.groupBy("lnr").agg(F.count("lnr").alias("anzahl"))
    return star.lieferant.join(counts.filter(F.col("anzahl") >= at_least), "lnr", "left_semi")


@query("j22_exists", "SELECT lnr, lname FROM lieferant WHERE lnr = ANY (SELECT lnr FROM lieferung)")
def _(star):
    return membership.where_exists(star.lieferant, star.lieferung, "lnr").select("lnr", "lname")


@query("j22_customers_with_events", f"{CUSTOMERS} SEMI JOIN events ON user_id = c_custkey")
def _(star):
    return membership.where_exists(customers(star), events(star), "kunde")


@query("j23_covers_other", """
    WITH ihre AS (SELECT DISTINCT anr FROM lieferung WHERE lnr = 2)
    SELECT d.lnr FROM (SELECT DISTINCT lnr, anr FROM lieferung) d JOIN ihre z ON z.anr = d.anr
    WHERE d.lnr <> 2 GROUP BY d.lnr HAVING count(*) = (SELECT count(*) FROM ihre)""")
def _(star):
    return division.covers_all_of(star.lieferung, "lnr", "anr", 2)


def priorities(star):
    return star.raw("orders").select(F.col("o_custkey").alias("kunde"), F.col("o_orderpriority").alias("prioritaet"))


@query("j23_customers_covering_other", """
    WITH p AS (SELECT DISTINCT o_custkey AS kunde, o_orderpriority AS prioritaet FROM orders),
         ihre AS (SELECT prioritaet FROM p WHERE kunde = 7)
    SELECT DISTINCT kunde FROM p x WHERE kunde <> 7 AND NOT EXISTS (
        FROM ihre WHERE prioritaet NOT IN (SELECT prioritaet FROM p y WHERE y.kunde = x.kunde))""")
def _(star):
    return division.covers_all_of(priorities(star), "kunde", "prioritaet", 7)


@query("j23_covering_other_by_bits", """
    WITH p AS (SELECT DISTINCT o_custkey AS kunde, o_orderpriority AS prioritaet FROM orders)
    SELECT kunde FROM p WHERE kunde <> 7 AND prioritaet IN (SELECT prioritaet FROM p WHERE kunde = 7)
    GROUP BY kunde HAVING count(*) = (SELECT count(*) FROM p WHERE kunde = 7)""")
def _(star):
    return division.covers_all_of_by_bits(priorities(star), "kunde", "prioritaet", 7)


@query("j24_every_priority_by_bits", """
    SELECT o_custkey AS kunde FROM orders GROUP BY o_custkey
    HAVING list_unique(list(o_orderpriority)) = (SELECT count(DISTINCT o_orderpriority) FROM orders)""")
def _(star):
    pairs = priorities(star)
    return division.divide_by_bits(pairs, "kunde", "prioritaet", pairs)


@query("j24_customers_of_every_priority", """
    SELECT o_custkey AS kunde FROM orders GROUP BY o_custkey
    HAVING count(DISTINCT o_orderpriority) = (SELECT count(DISTINCT o_orderpriority) FROM orders)""")
def _(star):
    pairs = priorities(star)
    return division.with_every(pairs, "kunde", "prioritaet", pairs.select("prioritaet").distinct())


@query("j24_all_of_a_table", """
    SELECT l_suppkey AS lnr FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY l_suppkey HAVING count(DISTINCT p_brand) = (SELECT count(DISTINCT p_brand) FROM part)""")
def _(star):
    parts = star.raw("part").select(F.col("p_partkey").alias("anr"), F.col("p_brand").alias("marke"))
    pairs = star.lieferung.join(parts, "anr")
    return division.with_every(pairs, "lnr", "marke", parts.select("marke").distinct())


@query("j24_every_brand_by_bits", """
    SELECT l_suppkey AS lnr FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY l_suppkey HAVING list_unique(list(p_brand)) = (SELECT count(DISTINCT p_brand) FROM part)""")
def _(star):
    parts = star.raw("part").select(F.col("p_partkey").alias("anr"), F.col("p_brand").alias("marke"))
    return division.divide_by_bits(star.lieferung.join(parts, "anr"), "lnr", "marke", parts)


@query("j25_independent_conditions", """
    SELECT ldatum FROM lieferung JOIN lieferant USING (lnr) JOIN artikel USING (anr)
    WHERE lstadt = 'NATION_3' AND farbe IN ('red', 'blue')""")
def _(star):
    return coloured_deliveries(star, "NATION_3", ("red", "blue")).select("ldatum")


def coloured_deliveries(star, place, colours):
    by_supplier = membership.only_in(star.lieferung, star.lieferant.filter(objects.at_place(place)), "lnr", unique=True)
    return membership.only_in(by_supplier, star.artikel.filter(text.text_in("farbe", *colours)), "anr", unique=True)


@query("j26_same_value_as", """
    SELECT b.anr, b.aname FROM artikel a JOIN artikel b ON a.astadt = b.astadt AND a.anr <> b.anr WHERE a.anr = 3""")
def _(star):
    return stored_with(star, 3)


def stored_with(star, part):
    same = text.comparable(star.artikel, "astadt")
    place = star.artikel.filter(F.col("anr") == F.lit(part)).select(same).scalar()
    return star.artikel.filter((same == place) & (F.col("anr") != F.lit(part))).select("anr", "aname")
