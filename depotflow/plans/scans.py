"""Sources, sinks, projections and scalar functions over the model tables."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F

from depotflow.functions import dates, numbers, text
from depotflow.operators import numbering
from depotflow.plans import objects
from depotflow.plans.registry import query
from depotflow.session import shared_folder
from depotflow.sources import readers, sinks, star as model

AS_OF = datetime(2002, 1, 15)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- sources and sinks ------------------------------------------------------------------------


@query("s1_all_columns", "SELECT lnr, lname, status, lstadt FROM lieferant")
def _(star):
    return star.lieferant


@query("s2_named_columns", """
    SELECT p_partkey AS anr, regexp_extract(p_name, '^[a-z]+') AS farbe, CAST(trunc(p_retailprice) AS BIGINT) AS amenge
    FROM part""")
def _(star):
    return star.artikel.select("anr", "farbe", "amenge")


@query("s3_qualified_name", "SELECT lnr, lname, lstadt FROM lieferant")
def _(star):
    database = f"lager_{uuid4().hex}"
    star.spark.sql(f"CREATE DATABASE {database}")
    sinks.into_table(star.lieferant, f"{database}.lieferant")
    return model.qualified(star.spark, f"server.spark_catalog.{database}.lieferant").select("lnr", "lname", "lstadt")


@query("s3_shared_view_name", "SELECT lnr, lname, lstadt FROM lieferant")
def _(star):
    sinks.into_shared_view(star.lieferant, "lieferant")
    return model.qualified(star.spark, "global_temp.lieferant").select("lnr", "lname", "lstadt")


@query("s7_text_keys", """
    SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) || 'Lagerkraft' AS namen,
           'Nr_' || CAST(o_orderkey AS VARCHAR) AS vname, format('{}_Halle_{}', o_orderkey, o_orderkey) AS ort
    FROM orders""")
def _(star):
    return star.raw("orders").select(*readers.text_keys("o_orderkey"))


@query("s7_text_search", """
    SELECT o_orderkey AS id FROM orders WHERE contains(CAST(o_orderkey AS VARCHAR), '309')""")
def _(star):
    return star.raw("orders").select(*readers.text_keys("o_orderkey")).filter(text.like("vname", "%309%")).select("id")


def numbered_suppliers(star):
    rows = star.lieferant.select("lnr", "lname", "lstadt")
    return numbering.number_rows(rows, [F.col("lnr").asc()], "laufende_nummer")


NUMBERED = "SELECT row_number() OVER (ORDER BY lnr) AS laufende_nummer, lnr, lname, lstadt FROM lieferant"


@query("s8_result_table", NUMBERED)
def _(star):
    return sinks.into_folder(numbered_suppliers(star), shared_folder(star.spark, "lief_m_nr"))


@query("s8_saved_table", NUMBERED)
def _(star):
    return sinks.into_table(numbered_suppliers(star), f"lief_m_nr_{uuid4().hex}")


@query("s11_append_to_table", "SELECT lnr, lname, status, lstadt FROM lieferant, range(2)")
def _(star):
    name = f"lief_hist_{uuid4().hex}"
    sinks.into_table(star.lieferant, name)
    sinks.append_to_table(star.lieferant, name)
    return star.spark.table(name)


@query("s9_session_view", NUMBERED)
def _(star):
    return sinks.into_session_view(numbered_suppliers(star), "lief_m_nr")


@query("s9_shared_view", NUMBERED)
def _(star):
    return sinks.into_shared_view(numbered_suppliers(star), "lief_m_nr")


@query("s10_renamed_variable", """
    SELECT count(*) OVER (ORDER BY lnr ROWS UNBOUNDED PRECEDING) AS laufende_nummer,
           lnr AS lieferantennummer, lname AS namen, lstadt AS ort FROM lieferant""")
def _(star):
    return numbered_suppliers(star).select(
        "laufende_nummer", F.col("lnr").alias("lieferantennummer"), F.col("lname").alias("namen"),
        F.col("lstadt").alias("ort"),
    )


@query("s11_append", """
    SELECT lnr, anr, lmenge, ldatum FROM lieferung UNION ALL SELECT lnr, anr, lmenge, ldatum FROM lieferung""")
def _(star):
    path = shared_folder(star.spark, "lieferung_hist")
    sinks.into_folder(star.lieferung, path)
    return sinks.append_to_folder(star.lieferung, path)


@query("s12_captured_result", """
    SELECT p_partkey AS artikelnummer, p_name AS artikelname, n_name AS lagerort
    FROM nation JOIN part ON p_partkey % 20 = n_nationkey WHERE starts_with(p_name, 'red ')""")
def _(star):
    found = objects.parts_by_colour(star, "red").toDF("artikelnummer", "artikelname", "lagerort")
    return sinks.into_folder(found, shared_folder(star.spark, "art_ergebnis"))


def deliveries_per_supplier(star):
    counts = star.lieferung.groupBy("lnr").agg(F.count("*").alias("anz"))
    return star.only("lieferant", "lnr", "lname").join(counts, "lnr")


REPORT = """SELECT lnr, any_value(lname) AS lname, count(*) AS anz
            FROM lieferant JOIN lieferung USING (lnr) GROUP BY lnr"""


@query("s13_xml_report", f"""
    WITH bericht AS ({REPORT})
    SELECT '<a><lnr>' || lnr || '</lnr><lname>' || lname || '</lname><anz>' || anz || '</anz></a>' AS zeile
    FROM bericht""")
def _(star):
    return deliveries_per_supplier(star).select(sinks.xml_elements("a", "lnr", "lname", "anz").alias("zeile"))


@query("s14_report_file", f"WITH bericht AS ({REPORT}) SELECT * FROM bericht")
def _(star):
    path = shared_folder(star.spark, "bericht")
    sinks.write_csv_report(deliveries_per_supplier(star), path)
    return star.spark.read.schema("lnr BIGINT, lname STRING, anz BIGINT").option("header", True).csv(path)


@query("e12_mail_report", REPORT)
def _(star):
    return deliveries_per_supplier(star)


# --- projections ------------------------------------------------------------------------------


@query("p1_column_order", "SELECT n_name AS lstadt, s_name AS lname FROM nation, supplier WHERE s_nationkey = n_nationkey")
def _(star):
    return star.lieferant.select("lstadt", "lname")


@query("p2_renamed", """
    SELECT anr AS artikelnummer, aname AS artikelname, gewicht AS gramm, astadt AS lagerort, amenge AS stueck
    FROM artikel""")
def _(star):
    return star.artikel.select(
        F.col("anr").alias("artikelnummer"), F.col("aname").alias("artikelname"), F.col("gewicht").alias("gramm"),
        F.col("astadt").alias("lagerort"), F.col("amenge").alias("stueck"),
    )


@query("p3_literals", "SELECT anr, gewicht, 'Gramm' AS gewichtseinheit, amenge, 'Stueck' AS lagereinheit FROM artikel")
def _(star):
    return star.artikel.select(
        "anr", "gewicht", F.lit("Gramm").alias("gewichtseinheit"), "amenge", F.lit("Stueck").alias("lagereinheit")
    )


@query("p4_arithmetic", """
    SELECT anr, amenge + 6 AS summe, 3 - amenge AS differenz, amenge * 3 AS produkt,
           round(amenge * 3.3, 1)::DOUBLE AS dezimal, CAST(amenge // 7 AS BIGINT) AS ganzzahl,
           round(amenge / 2.0, 1)::DOUBLE AS bruch,
           amenge % 7 AS rest
    FROM artikel""")
def _(star):
    amount = F.col("amenge")
    return star.artikel.select(
        "anr", (amount + 6).alias("summe"), (3 - amount).alias("differenz"), (amount * 3).alias("produkt"),
        (amount * F.lit("3.3").cast("decimal(2,1)")).alias("dezimal"),
        numbers.whole_division("amenge", F.lit(7)).alias("ganzzahl"), (amount / 2).alias("bruch"),
        (amount % 7).alias("rest"),
    )


@query("p5_computed_columns", """
    SELECT anr, aname, round(gewicht / 1000, 3) AS kilo, round(gewicht * amenge / 1000, 3) AS lagergewicht
    FROM artikel""")
def _(star):
    kilo = numbers.kilograms("gewicht")
    return star.artikel.select("anr", "aname", kilo.alias("kilo"), (kilo * F.col("amenge")).alias("lagergewicht"))


@query("p6_concatenation", """
    SELECT lnr, 'Der Lieferant ' || lname || ' (' || lnr || '), wohnt in ' || lstadt
                || ' und hat einen Status von ' || status AS satz
    FROM lieferant""")
def _(star):
    return star.lieferant.select("lnr", text.supplier_sentence("lname", "lnr", "lstadt", "status").alias("satz"))


@query("p7_simple_case", """
    SELECT lnr, lstadt, CASE WHEN lstadt = 'NATION_3' THEN 'wohnt im Norden'
                             WHEN lstadt = 'NATION_7' THEN 'wohnt im Westen'
                             ELSE 'wohnt auch' END AS bewertung FROM lieferant""")
def _(star):
    rating = (
        F.when(text.same_text("lstadt", "NATION_3"), "wohnt im Norden")
        .when(text.same_text("lstadt", "NATION_7"), "wohnt im Westen")
        .otherwise("wohnt auch")
    )
    return star.lieferant.select("lnr", "lstadt", rating.alias("bewertung"))


@query("p8_searched_case", """
    SELECT anr, CASE WHEN farbe = 'green' AND amenge < 950 THEN 'knapp'
                     WHEN farbe = 'black' OR amenge >= 1000 THEN 'reichlich'
                     ELSE 'ausreichend' END AS vorrat FROM artikel""")
def _(star):
    supply = (
        F.when(text.same_text("farbe", "green") & (F.col("amenge") < 950), "knapp")
        .when(text.same_text("farbe", "black") | (F.col("amenge") >= 1000), "reichlich")
        .otherwise("ausreichend")
    )
    return star.artikel.select("anr", supply.alias("vorrat"))


@query("p9_case_on_group", """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'Fertig' WHEN 'O' THEN 'Offen' WHEN 'P' THEN 'Teilweise' END AS art,
           count(*) AS anzahl
    FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY ALL""")
def _(star):
    label = F.when(F.col("o_orderstatus") == "F", "Fertig").when(F.col("o_orderstatus") == "O", "Offen")
    label = label.when(F.col("o_orderstatus") == "P", "Teilweise")
    return (
        star.raw("orders").filter(F.col("o_orderstatus").isin("F", "O", "P"))
        .groupBy("o_orderstatus").agg(F.count("*").alias("anzahl"))
        .select(label.alias("art"), F.coalesce("anzahl", F.lit(0)).alias("anzahl"))
    )


@query("p10_null_replaced", """
    SELECT lnr, lname, CASE WHEN status IS NULL THEN 50 ELSE status END AS status FROM lieferant""")
def _(star):
    return star.lieferant.select("lnr", "lname", F.coalesce("status", F.lit(50)).alias("status"))


@query("p11_distinct", "SELECT lnr FROM lieferung GROUP BY lnr")
def _(star):
    return star.lieferung.select("lnr").distinct()


@query("p12_cast", """
    SELECT lnr, CAST(status AS VARCHAR) AS text, CAST(CAST(lnr AS VARCHAR) AS INTEGER) + 100 AS zahl FROM lieferant""")
def _(star):
    return star.lieferant.select(
        "lnr", F.col("status").cast("string").alias("text"),
        (F.col("lnr").cast("string").cast("int") + 100).alias("zahl"),
    )


@query("p13_text_bounds", "SELECT lnr FROM lieferant WHERE status >= 20 AND status <= 30")
def _(star):
    low, high = (F.lit(bound).cast("int") for bound in ("20", "30"))
    return star.lieferant.filter(F.col("status").between(low, high)).select("lnr")


@query("p14_code_rewrite", """
    SELECT lnr, 'K' || (CAST(regexp_extract(lname, '[0-9]+') AS INTEGER) + 100) AS neu FROM lieferant""")
def _(star):
    code = F.concat(F.lit("L"), F.substring_index("lname", "#", -1))
    return star.lieferant.select("lnr", text.shifted_code(code, "K", 100).alias("neu"))


@query("p15_deviation", """
    SELECT anr, gewicht, round(gewicht - avg(gewicht) OVER (), 6) AS abweichung FROM artikel""")
def _(star):
    mean = star.artikel.agg(F.avg(F.col("gewicht").cast("double"))).scalar()
    deviation = F.round(F.col("gewicht").cast("double") - mean, 6)
    return star.artikel.select("anr", "gewicht", deviation.alias("abweichung"))


GERMAN_MONTH = """(['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September',
                    'Oktober', 'November', 'Dezember'])[month(ldatum)]"""
GERMAN_DAY = """(['Montag', 'Dienstag', 'Mittwoch', 'Donnerstag', 'Freitag', 'Samstag', 'Sonntag'])[isodow(ldatum)]"""


@query("p16_date_sentence", f"""
    SELECT anr AS artikelnummer, lmenge AS liefermenge,
           format('{{}} der {{}}. {{}} {{}}', {GERMAN_DAY}, day(ldatum), {GERMAN_MONTH}, year(ldatum)) AS lieferdatum
    FROM lieferung""")
def delivery_sentences(star):
    return star.lieferung.select(
        F.col("anr").alias("artikelnummer"), F.col("lmenge").alias("liefermenge"),
        dates.long_date("ldatum").alias("lieferdatum"),
    )


@query("e2_1_date_sentence", f"""
    SELECT anr AS artikelnummer, lmenge AS liefermenge,
           concat({GERMAN_DAY}, ' der ', day(ldatum), '. ', {GERMAN_MONTH}, ' ', year(ldatum)) AS lieferdatum
    FROM lieferung""")
def _(star):
    return delivery_sentences(star)


AGE = """
    WITH alter_in_tagen AS (
        SELECT anr, ldatum, date_diff('day', ldatum, TIMESTAMP '2002-01-15') AS tage FROM lieferung)
    SELECT anr AS artikelnummer, strftime(ldatum, '%d.%m.%Y') AS lieferdatum,
           format('vor {} Jahren und {} Monaten.', tage // 365,
                  CAST(floor((tage - 365.25 * floor(tage / 365.25)) / 30.4375) AS INTEGER)) AS die_lieferung
    FROM alter_in_tagen"""


def delivery_ages(star, moment):
    return star.lieferung.select(
        F.col("anr").alias("artikelnummer"), dates.german_text("ldatum").alias("lieferdatum"),
        dates.age_sentence("ldatum", moment).alias("die_lieferung"),
    )


@query("p17_age_sentence", AGE)
def _(star):
    return delivery_ages(star, as_of())


@query("e2_2_age_sentence", AGE)
def _(star):
    return delivery_ages(star, as_of())


@query("p18_safe_ratio", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 8 ELSE 0 END AS status,
           CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS quotient
    FROM lineitem""")
def _(star):
    return star.raw("lineitem").select(
        "l_orderkey", "l_linenumber", numbers.ratio_status("l_discount").alias("status"),
        F.round(numbers.ratio("l_tax", "l_discount"), 6).alias("quotient"),
    )


@query("p18_ratio_defaults", """
    SELECT lnr, round(coalesce(CAST(status AS DOUBLE), 1.0) / 34.99, 6) AS quotient FROM lieferant""")
def _(star):
    return star.lieferant.select("lnr", F.round(numbers.ratio("status", F.lit(34.99)), 6).alias("quotient"))


# --- scalar functions -------------------------------------------------------------------------


@query("x1_lengths", r"""
    SELECT doc_id, length(rtrim(text, ' '))::INTEGER AS zeichen,
           CAST(4 * length(text) - 2 * length(regexp_replace(text, '[\x{10000}-\x{10FFFF}]', '', 'g')) AS INTEGER) AS bytes
    FROM documents""")
def _(star):
    return star.raw("documents").select(
        "doc_id", text.char_count("text").alias("zeichen"), text.byte_length("text").alias("bytes")
    )


@query("x2_substring", "SELECT anr, aname[2:2] AS zweiter_buchstabe FROM artikel")
def _(star):
    return star.artikel.select("anr", F.substring("aname", 2, 1).alias("zweiter_buchstabe"))


@query("x3_replace", "SELECT anr, regexp_replace(aname, 'red', 'rot', 'gi') AS neu FROM artikel")
def _(star):
    return star.artikel.select("anr", text.replace_text("aname", "RED", "rot").alias("neu"))


@query("x4_replicate", "SELECT anr, farbe || farbe || farbe AS dreimal FROM artikel")
def _(star):
    return star.artikel.select("anr", F.repeat("farbe", 3).alias("dreimal"))


@query("x5_blanks", "SELECT lnr, concat(lname, repeat(' ', 20), lstadt) AS zeile FROM lieferant")
def _(star):
    return star.lieferant.select("lnr", text.joined_with_blanks("lname", 20, "lstadt").alias("zeile"))


@query("x6_quotation_mark", "SELECT anr, '''' || farbe || '''' AS zitat FROM artikel")
def _(star):
    return star.artikel.select("anr", text.quoted("farbe").alias("zitat"))


@query("x7_round", """
    SELECT o_orderkey, round(o_totalprice, 1) AS zehntel, round(o_totalprice, -2) AS hunderter FROM orders""")
def _(star):
    return star.raw("orders").select(
        "o_orderkey", F.round("o_totalprice", 1).alias("zehntel"), F.round("o_totalprice", -2).alias("hunderter")
    )


@query("x8_random", """
    SELECT count(*) AS zeilen, 1 AS werte, TRUE AS im_bereich FROM lieferung""")
def _(star):
    rows = star.lieferung.select(numbers.statement_random().alias("zufall"))
    return rows.agg(
        F.count("*").alias("zeilen"), F.countDistinct("zufall").cast("int").alias("werte"),
        F.every(F.round(F.col("zufall") * 100, 0).between(0, 100)).alias("im_bereich"),
    )


@query("x9_new_ids", "SELECT count(*) AS zeilen, count(*) AS werte FROM lieferung")
def _(star):
    ids = star.lieferung.select(F.uuid().alias("id"))
    return ids.agg(F.count("*").alias("zeilen"), F.countDistinct("id").alias("werte"))


@query("x10_current_time", "SELECT count(*) AS vergangen FROM lieferung WHERE ldatum < TIMESTAMP '2020-01-01'")
def _(star):
    return star.lieferung.filter(F.col("ldatum") < F.current_timestamp()).agg(F.count("*").alias("vergangen"))


@query("x11_date_parts", """
    SELECT lnr, anr, extract(day FROM ldatum)::INTEGER AS tag, extract(month FROM ldatum)::INTEGER AS monat,
           extract(year FROM ldatum)::INTEGER AS jahr FROM lieferung""")
def _(star):
    return star.lieferung.select(
        "lnr", "anr", F.dayofmonth("ldatum").alias("tag"), F.month("ldatum").alias("monat"),
        F.year("ldatum").alias("jahr"),
    )


@query("x12_week_parts", """
    SELECT lnr, anr, isodow(ldatum)::INTEGER AS wochentag, (dayofweek(ldatum) + 1)::INTEGER AS wochentag_ab_sonntag,
           (dayofyear(ldatum) + isodow(date_trunc('year', ldatum)) - 2) // 7 + 1 AS woche
    FROM lieferung""")
def _(star):
    return star.lieferung.select(
        "lnr", "anr", dates.weekday_number("ldatum").alias("wochentag"),
        dates.weekday_number("ldatum", first_day=7).alias("wochentag_ab_sonntag"),
        dates.week_of_year("ldatum").alias("woche"),
    )


@query("x13_german_names", f"""
    SELECT lnr, anr, {GERMAN_DAY} AS tag, {GERMAN_MONTH} AS monat, CAST(year(ldatum) AS VARCHAR) AS jahr
    FROM lieferung""")
def _(star):
    return star.lieferung.select(
        "lnr", "anr", dates.weekday_name("ldatum").alias("tag"), dates.month_name("ldatum").alias("monat"),
        F.year("ldatum").cast("string").alias("jahr"),
    )


@query("x14_date_added", "SELECT lnr, anr, ldatum, ldatum + to_days(37) AS zahlung FROM lieferung")
def _(star):
    payment = F.col("ldatum") + F.expr("INTERVAL 37 DAYS")
    return star.lieferung.select("lnr", "anr", "ldatum", payment.alias("zahlung"))


@query("x15_month_boundaries", """
    SELECT lnr, anr, ldatum, date_diff('month', ldatum, TIMESTAMP '2002-01-15')::INTEGER AS monate FROM lieferung""")
def _(star):
    return star.lieferung.select("lnr", "anr", "ldatum", dates.months_between("ldatum", as_of()).alias("monate"))


@query("x16_day_boundaries", """
    SELECT event_id, CAST(DATE '2024-03-01' - CAST(ts AS DATE) AS INTEGER) AS tage FROM events""")
def _(star):
    until = F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz")
    return star.raw("events").select("event_id", dates.days_between("ts", until).alias("tage"))


@query("x17_german_format", "SELECT lnr, anr, strftime(ldatum, '%d.%m.%Y') AS datum FROM lieferung")
def _(star):
    return star.lieferung.select("lnr", "anr", dates.german_text("ldatum").alias("datum"))


@query("x18_german_parse", "SELECT lnr, anr, ldatum AS kurz, ldatum AS lang FROM lieferung")
def _(star):
    short, long = (F.date_format("ldatum", form) for form in ("dd.MM.yy", "dd.MM.yyyy"))
    return star.lieferung.select(
        "lnr", "anr", dates.parse_german(short).alias("kurz"), dates.parse_german(long).alias("lang")
    )


@query("x19_iso_week", "SELECT lnr, anr, ldatum, CAST(strftime(ldatum, '%V') AS INTEGER) AS woche FROM lieferung")
def _(star):
    return star.lieferung.select("lnr", "anr", "ldatum", dates.iso_week("ldatum").alias("woche"))


@query("x20_separated_date", "SELECT lnr, anr, strftime(ldatum, '%-d#%-m#%Y') AS datum FROM lieferung")
def _(star):
    return star.lieferung.select("lnr", "anr", dates.day_month_year("ldatum", "#").alias("datum"))


@query("x21_postcode", """
    SELECT o_orderkey, o_orderkey * 7 BETWEEN 10000 AND 99999 AS gueltig FROM orders""")
def _(star):
    return star.raw("orders").select(
        "o_orderkey", text.valid_postcode((F.col("o_orderkey") * 7).cast("string")).alias("gueltig")
    )


@query("x22_week_sentence", f"""
    SELECT lnr, anr, {GERMAN_DAY} || ' in der ' || week(ldatum) || ' Kalenderwoche' AS satz FROM lieferung""")
def _(star):
    return star.lieferung.select("lnr", "anr", dates.week_sentence("ldatum").alias("satz"))


@query("x23_user_stamp", "SELECT count(*) AS zeilen, 1 AS benutzer FROM lieferant")
def _(star):
    stamped = star.lieferant.select(F.current_user().alias("wer"))
    return stamped.agg(F.count("*").alias("zeilen"), F.countDistinct("wer").cast("int").alias("benutzer"))
