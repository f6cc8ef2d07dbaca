"""Table changes, checks and parameterised objects over the model tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from depotflow.functions import dates, numbers, text
from depotflow.operators import audit, changes, numbering, receipt, stock, validation
from depotflow.plans import objects
from depotflow.plans.registry import query
from depotflow.session import frozen, shared_folder
from depotflow.sources import sinks
from depotflow.streaming import stock_feed

SUPPLIER = "SELECT lnr, lname, status, lstadt FROM lieferant"

# Customers get numbers behind the suppliers' when they become suppliers.
FIRST_NEW = 1_000_000_000


def new_suppliers(star):
    """Customers as supplier rows without a place."""
    return star.raw("customer").select(
        (F.col("c_custkey") + FIRST_NEW).alias("lnr"), F.col("c_name").alias("lname"), F.lit(5).alias("status")
    )


NEW = f"SELECT c_custkey + {FIRST_NEW} AS lnr, c_name AS lname, 5 AS status"


@query("d1_insert_named_columns", f"{SUPPLIER} UNION ALL {NEW}, NULL FROM customer")
def _(star):
    return changes.insert(star.lieferant, new_suppliers(star).select("lname", "status", "lnr"))


@query("d1_insert_by_position", f"{SUPPLIER} UNION ALL {NEW}, c_mktsegment FROM customer")
def _(star):
    rows = star.raw("customer").select(
        F.col("c_custkey") + FIRST_NEW, "c_name", F.lit(5), F.col("c_mktsegment").alias("segment")
    )
    return changes.insert_by_position(star.lieferant, rows)


@query("d1_insert_numbered", """
    SELECT 999 + row_number() OVER (ORDER BY lnr) AS m_nr, lname AS m_name FROM lieferant
    UNION ALL
    SELECT 999 + (SELECT count(*) FROM supplier) + row_number() OVER (ORDER BY c_custkey), c_name FROM customer""")
def _(star):
    suppliers = star.only("lieferant", "lnr", "lname")
    staff = numbering.number_rows(suppliers, [F.col("lnr")], "m_nr", start=1000).select(
        "m_nr", F.col("lname").alias("m_name")
    )
    hired = star.raw("customer").select("c_custkey", F.col("c_name").alias("m_name"))
    return changes.insert_numbered(staff, hired, "m_nr", [F.col("c_custkey")])


@query("d2_update", f"""
    SELECT lnr, lname, status, CASE WHEN status < 20 THEN 'Gotha' ELSE lstadt END AS lstadt FROM lieferant""")
def _(star):
    return changes.update(star.lieferant, F.col("status") < 20, lstadt=F.lit("Gotha"))


@query("d3_update_members", """
    SELECT s.lnr, lname, lstadt, CAST(status + CASE WHEN n > 600 THEN 5 ELSE 0 END AS INTEGER) AS status
    FROM lieferant s LEFT JOIN (SELECT lnr, count(*) AS n FROM lieferung GROUP BY lnr) d ON d.lnr = s.lnr""")
def _(star):
    return raise_status(star, more_than=600, points=5)


def raise_status(star, more_than, points):
    counts = star.lieferung.groupBy("lnr").agg(F.count("lnr").alias("anzahl")).filter(F.col("anzahl") > more_than)
    return changes.update_members(star.lieferant, counts, "lnr", status=F.col("status") + points)


@query("d5_delete", f"{SUPPLIER} WHERE status IS NULL OR status >= 20")
def _(star):
    return changes.delete(star.lieferant, F.col("status") < 20)


@query("d6_delete_unmatched", f"{SUPPLIER} WHERE lnr = 5 UNION {SUPPLIER} JOIN lieferung USING (lnr)")
def _(star):
    return changes.delete_unmatched(star.lieferant, star.lieferung, "lnr", spared=F.col("lnr") == 5)


@query("d6_delete_unlabelled", """
    SELECT doc_id, lang, source FROM documents WHERE lang = 'de' UNION
    SELECT doc_id, lang, source FROM documents JOIN labels USING (doc_id)""")
def _(star):
    documents = star.raw("documents").select("doc_id", "lang", "source")
    return changes.delete_unmatched(documents, star.raw("labels"), "doc_id", spared=text.same_text("lang", "DE"))


@query("d7_truncate", "SELECT lnr, anr, lmenge, ldatum FROM lieferung WHERE FALSE")
def _(star):
    return changes.truncate(star.lieferung)


STAMP = datetime(2002, 1, 15)


def audited(star):
    """Audit of three changes to the suppliers at once: new ones, moved ones, removed ones."""
    new, hit, gone = new_suppliers(star), F.col("status").between(10, 50), F.col("status") > 90
    table = changes.insert(star.lieferant, new)
    moved = audit.updated(table, hit, "lnr", lstadt=F.lit("NATION_3"))
    table = changes.update(table, hit, lstadt=F.lit("NATION_3"))
    return audit.stamped(
        audit.inserted(new, "lnr"), moved, audit.deleted(table, gone, "lnr"), number=2, when=STAMP, who=F.lit("pruefer")
    )


@query("d8_audit", f"""
    WITH zeilen AS (
        SELECT 'Update' AS was, lnr, 'NATION_3' AS neu, lstadt AS alt FROM lieferant WHERE status BETWEEN 10 AND 50
        UNION ALL SELECT 'Delete', lnr, NULL, CAST(lnr AS VARCHAR) FROM lieferant WHERE status > 90
        UNION ALL SELECT 'Insert', c_custkey + {FIRST_NEW}, CAST(c_custkey + {FIRST_NEW} AS VARCHAR), NULL FROM customer)
    SELECT 2 AS lfdnr, TIMESTAMP '2002-01-15' AS wann, 'pruefer' AS wer, was,
           CAST(lnr AS VARCHAR) AS primaerschluessel, neu AS neuer_wert, alt AS alter_wert FROM zeilen""")
def _(star):
    return audited(star)


@query("d8_audit_of_columns", """
    WITH zeilen AS (FROM lieferant WHERE lnr BETWEEN 5 AND 60)
    SELECT 3 AS lfdnr, TIMESTAMP '2002-01-15' AS wann, 'pruefer' AS wer, 'Update' AS was,
           CAST(lnr AS VARCHAR) AS primaerschluessel, 'lstadt' AS spalte, 'NATION_7' AS neuer_wert, lstadt AS alter_wert
    FROM zeilen UNION ALL
    SELECT 3, TIMESTAMP '2002-01-15', 'pruefer', 'Update', CAST(lnr AS VARCHAR), 'status', CAST(status + 1 AS VARCHAR),
           CAST(status AS VARCHAR) FROM zeilen""")
def _(star):
    touched = audit.updated(
        star.lieferant, F.col("lnr").between(5, 60), "lnr", lstadt=F.lit("NATION_7"), status=F.col("status") + 1)
    return audit.stamped(touched, number=3, when=STAMP, who=F.lit("pruefer"), columns=True)


# --- stock levels -----------------------------------------------------------------------------


def lines(star, flag):
    rows = star.raw("lineitem").filter(F.col("l_returnflag") == flag)
    return rows.select(F.col("l_partkey").alias("anr"), F.col("l_quantity").cast("int").alias("lmenge"))


def stock_sql(change):
    return f"""
        SELECT anr, aname, farbe, gewicht, astadt,
               CAST(amenge + coalesce((SELECT sum({change}) FROM lineitem WHERE l_partkey = anr), 0) AS BIGINT) AS amenge
        FROM artikel"""


@query("d4_update_from_join", stock_sql("l_quantity"))
def _(star):
    return stock.maintain_stock(star.artikel, inserted=star.lieferung)


@query("d9_stock_on_insert", stock_sql("CASE WHEN l_returnflag = 'N' THEN l_quantity END"))
def _(star):
    return stock.maintain_stock(star.artikel, inserted=lines(star, "N"))


@query("d10_stock_on_delete", stock_sql("CASE WHEN l_returnflag = 'R' THEN -l_quantity END"))
def _(star):
    return stock.maintain_stock(star.artikel, deleted=lines(star, "R"))


@query("d11_stock_on_new_part", """
    WITH menge AS (SELECT l_partkey AS anr, CAST(sum(l_quantity) AS BIGINT) AS m FROM lineitem
                   WHERE l_returnflag = 'R' GROUP BY l_partkey),
         verschoben AS (SELECT xor(anr, 1) AS anr, m FROM menge)
    SELECT a.anr, aname, farbe, gewicht, astadt,
           CAST(amenge - coalesce(menge.m, 0) + coalesce(verschoben.m, 0) AS BIGINT) AS amenge
    FROM artikel a LEFT JOIN menge ON menge.anr = a.anr LEFT JOIN verschoben ON verschoben.anr = a.anr""")
def _(star):
    before = lines(star, "R")
    # The delivery was booked on the part's neighbour by mistake.
    after = before.withColumn("anr", F.col("anr").bitwiseXOR(1))
    return stock.maintain_stock(star.artikel, inserted=after, deleted=before)


@query("d12_stock_on_new_quantity", stock_sql("CASE WHEN l_returnflag = 'A' THEN l_linenumber - 3 ELSE 0 END"))
def _(star):
    old = star.raw("lineitem").filter(F.col("l_returnflag") == "A").select(
        F.col("l_partkey").alias("anr"), F.col("l_quantity").cast("int").alias("lmenge"), "l_linenumber"
    )
    new = old.withColumn("lmenge", F.col("lmenge") + F.col("l_linenumber") - 3)
    return stock.maintain_stock(star.artikel, inserted=new, deleted=old)


FEED = """
    SELECT CASE l_returnflag WHEN 'R' THEN 'Delete' WHEN 'N' THEN 'Insert' ELSE 'insert' END AS was,
           CASE WHEN l_linenumber <> 7 THEN l_partkey END AS anr,
           CASE WHEN l_discount <> 0.1 THEN CAST(l_quantity AS INTEGER) END AS lmenge FROM lineitem"""


def streamed(star):
    """Folder of a feed of order lines as changes, some of a kind that is not known, some without part or quantity.

    The feed lies in several files and is read in several batches.
    """
    flag = F.col("l_returnflag")
    feed = star.raw("lineitem").select(
        F.when(flag == "R", "Delete").when(flag == "N", "Insert").otherwise("insert").alias("was"),
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("anr"),
        F.when(F.col("l_discount") != 0.1, F.col("l_quantity").cast("int")).alias("lmenge"),
    )
    source, folder = shared_folder(star.spark, "zugang"), shared_folder(star.spark, "bestand")
    feed.repartition(6, "anr", "lmenge").write.parquet(source)
    stream = star.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(source)
    stock_feed.start(stream, folder, f"{folder}/fortschritt").awaitTermination()
    return folder


@query("d9_stock_stream", f"""
    WITH buchung AS (SELECT anr, sum(CASE was WHEN 'Delete' THEN -lmenge WHEN 'Insert' THEN lmenge END) AS m
                     FROM ({FEED}) WHERE anr IS NOT NULL GROUP BY anr)
    SELECT a.anr, aname, farbe, gewicht, astadt, CAST(amenge + coalesce(m, 0) AS BIGINT) AS amenge
    FROM artikel a LEFT JOIN buchung b ON b.anr = a.anr""")
def _(star):
    return stock_feed.current_stock(star.spark, star.artikel, streamed(star))


@query("d9_stream_rejects", f"""
    SELECT was, anr, lmenge, CASE WHEN was = 'insert' THEN 'was' WHEN anr IS NULL THEN 'anr' ELSE 'lmenge' END AS grund
    FROM ({FEED}) WHERE was = 'insert' OR anr IS NULL OR lmenge IS NULL""")
def _(star):
    return stock_feed.rejects(star.spark, streamed(star))


def checked_sql(change, low, high):
    """The new levels if all changed parts keep the rule, else the old ones."""
    return f"""
        WITH neu AS (SELECT a.*, CAST(amenge + m AS BIGINT) AS stand FROM artikel a LEFT JOIN (
                         SELECT l_partkey, sum({change}) AS m FROM lineitem GROUP BY l_partkey) ON l_partkey = anr)
        SELECT anr, aname, farbe, gewicht, astadt,
               CASE WHEN (SELECT count(*) FROM neu WHERE stand NOT BETWEEN {low} AND {high}) = 0
                    THEN coalesce(stand, amenge) ELSE amenge END AS amenge FROM neu"""


@query("d9_accepted_stock", checked_sql("l_quantity", 0, 10000))
def _(star):
    return stock.checked_stock(star.artikel, stock.stock_delta(inserted=star.lieferung))[0]


@query("d9_refused_stock", checked_sql("-l_quantity", 0, 10000))
def _(star):
    return stock.checked_stock(star.artikel, stock.stock_delta(deleted=star.lieferung))[0]


@query("d9_broken_parts", """
    SELECT anr, CAST(amenge - m AS BIGINT) AS amenge FROM artikel JOIN (
        SELECT l_partkey, sum(l_quantity) AS m FROM lineitem GROUP BY l_partkey) ON l_partkey = anr
    WHERE amenge - m NOT BETWEEN 0 AND 10000""")
def _(star):
    return stock.checked_stock(star.artikel, stock.stock_delta(deleted=star.lieferung))[1].select("anr", "amenge")


LINES = """
    SELECT l_partkey AS anr, l_orderkey * 8 + l_linenumber AS nr, l_returnflag <> 'R' AS zugang,
           CAST(l_quantity AS BIGINT) * 40 AS lmenge FROM lineitem"""
#: Every change of a part in order, with the level that those before it have left.
MET = f"""
    folge AS (
        SELECT anr, list(weg ORDER BY nr, weg) AS wege, list(nr ORDER BY nr) AS nrn
        FROM (SELECT anr, nr, CASE WHEN zugang THEN lmenge ELSE -lmenge END AS weg FROM ({LINES})) GROUP BY anr),
    stufen AS (
        SELECT folge.*, unnest(generate_series(0, len(wege))) AS i, amenge FROM folge JOIN artikel USING (anr)),
    erreicht AS (
        SELECT anr, i, wege, nrn, list_reduce(list_prepend(amenge, wege[1:i]), lambda stand, weg:
                   CASE WHEN stand + weg BETWEEN 0 AND 10000 THEN stand + weg ELSE stand END) AS stand
        FROM stufen)"""


def guarded(star):
    """Folder of a feed of order lines as large changes of stock, in three batches in the order of the orders."""
    lines = star.raw("lineitem").select(
        F.col("l_partkey").alias("anr"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("nr"),
        F.when(F.col("l_returnflag") == "R", "Delete").otherwise("Insert").alias("was"),
        (F.col("l_quantity").cast("long") * 40).cast("int").alias("lmenge"))
    source, folder = shared_folder(star.spark, "zugang"), shared_folder(star.spark, "bestand")
    last = lines.agg(F.max("nr")).scalar()
    place = frozen(lines.withColumn("teil", F.least(F.lit(2), F.floor(F.col("nr") * 3 / last))))
    for number in range(3):
        # Four files a batch, each with all changes of its parts.
        place.filter(F.col("teil") == number).drop("teil").repartition(4, "anr").write.mode("append").parquet(source)
    stream = star.spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 4).parquet(source)
    rule = stock_feed.stock_rule(star.artikel, folder, "nr")
    stock_feed.start(stream, folder, f"{folder}/fortschritt", rule).awaitTermination()
    return folder


@query("d9_stream_guarded_stock", f"""
    WITH {MET}
    SELECT a.anr, aname, farbe, gewicht, astadt, CAST(coalesce(stand, amenge) AS BIGINT) AS amenge
    FROM artikel a LEFT JOIN (SELECT anr, stand FROM erreicht WHERE i = len(wege)) USING (anr)""")
def _(star):
    return stock_feed.current_stock(star.spark, star.artikel, guarded(star))


@query("d9_stream_refused", f"""
    WITH {MET}
    SELECT anr, nrn[i + 1] AS nr, CASE WHEN wege[i + 1] < 0 THEN 'Delete' ELSE 'Insert' END AS was,
           CAST(abs(wege[i + 1]) AS INTEGER) AS lmenge, CAST(stand AS BIGINT) AS stand
    FROM erreicht WHERE i < len(wege) AND stand + wege[i + 1] NOT BETWEEN 0 AND 10000""")
def _(star):
    return stock_feed.refused(star.spark, guarded(star))


# --- routing and views ------------------------------------------------------------------------


def order_feed(star):
    """Joined rows of suppliers and deliveries: every order line, delivered by the order's customer."""
    orders = star.raw("orders").select("o_orderkey", "o_custkey")
    customers = star.raw("customer").select("c_custkey", "c_name", "c_mktsegment")
    items = star.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_custkey").alias("lnr"), F.col("c_name").alias("lname"), F.lit(10).alias("status"),
            F.col("c_mktsegment").alias("lstadt"), F.col("l_partkey").alias("anr"),
            F.col("l_quantity").cast("int").alias("lmenge"), F.col("l_shipdate").alias("ldatum"),
        )
    )


@query("d13_routed_suppliers", """
    SELECT c_custkey AS lnr, c_name AS lname, 10 AS status, c_mktsegment AS lstadt FROM customer
    WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey)
      AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(star):
    return changes.route_joined_feed(order_feed(star), star.lieferant, star.lieferung, "lnr")[0]


@query("d13_routed_deliveries", """
    SELECT o_custkey AS lnr, l_partkey AS anr, CAST(l_quantity AS INTEGER) AS lmenge, l_shipdate AS ldatum
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(star):
    return changes.route_joined_feed(order_feed(star), star.lieferant, star.lieferung, "lnr")[1]


@query("d14_refused_inserts", "SELECT anr, aname, 'keine neuen Artikel' AS grund FROM artikel")
def _(star):
    return changes.refuse_all(star.artikel.select("anr", "aname"), "keine neuen Artikel")


def machinery():
    return text.same_text("lstadt", "machinery")



def segment_suppliers(star):
    return star.raw("customer").select(
        (F.col("c_custkey") + FIRST_NEW).alias("lnr"), F.col("c_name").alias("lname"), F.lit(None).cast("int").alias("status"),
        F.col("c_mktsegment").alias("lstadt"),
    )


@query("d15_accepted_by_view", f"""
    SELECT c_custkey + {FIRST_NEW} AS lnr, c_name AS lname, CAST(NULL AS INTEGER) AS status, c_mktsegment AS lstadt
    FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def _(star):
    return changes.split_by_view(segment_suppliers(star), machinery())[0]


@query("d15_refused_by_view", f"""
    SELECT c_custkey + {FIRST_NEW} AS lnr, c_mktsegment AS lstadt FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def _(star):
    return changes.split_by_view(segment_suppliers(star), machinery())[1].select("lnr", "lstadt")


@query("d15_inserted_through_view", f"""
    SELECT lnr, lname, lstadt FROM lieferant WHERE lstadt = 'NATION_3'
    UNION ALL SELECT c_custkey + {FIRST_NEW}, c_name, 'NATION_3' FROM customer WHERE c_nationkey = 3""")
def _(star):
    nation = star.raw("nation")
    rows = star.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (F.col("c_custkey") + FIRST_NEW).alias("lnr"), F.col("c_name").alias("lname"), F.col("n_name").alias("lstadt")
    )
    # Without the check every row is accepted; the view shows the ones it can.
    table = changes.insert(star.lieferant, rows)
    return objects.suppliers_at(star.with_tables(lieferant=table), "NATION_3")


@query("d16_update_through_view", """
    SELECT lnr, lstadt, status,
           CASE WHEN lstadt = 'NATION_3' AND status > 40 THEN 'Fruehaufsteher' ELSE lname END AS lname
    FROM lieferant""")
def _(star):
    at_city = objects.at_place("NATION_3")
    return changes.update_through_view(star.lieferant, at_city, F.col("status") > 40, lname=F.lit("Fruehaufsteher"))


@query("d16_refused_view_update", """
    SELECT lnr, lname, status, 'Erfurt' AS lstadt FROM lieferant WHERE lstadt = 'NATION_7' AND status > 40""")
def _(star):
    at_city = objects.at_place("NATION_7")
    return changes.checked_view_update(star.lieferant, at_city, F.col("status") > 40, lstadt=F.lit("Erfurt"))[1]


@query("d16_checked_view_update", SUPPLIER)
def _(star):
    at_city = objects.at_place("NATION_7")
    return changes.checked_view_update(star.lieferant, at_city, F.col("status") > 40, lstadt=F.lit("Erfurt"))[0]


@query("d16_delete_through_view", f"""
    {SUPPLIER} WHERE lstadt <> 'NATION_7' OR lnr IN (SELECT lnr FROM lieferung)""")
def _(star):
    return changes.delete_through_view(star.lieferant, objects.at_place("NATION_7"), star.lieferung, "lnr")


@query("d16_delete_unlabelled_through_view", """
    SELECT doc_id, lang, source FROM documents WHERE lang <> 'en' OR doc_id IN (SELECT doc_id FROM labels)""")
def _(star):
    documents = star.raw("documents").select("doc_id", "lang", "source")
    return changes.delete_through_view(documents, text.same_text("lang", "EN"), star.raw("labels"), "doc_id")


# --- constraints ------------------------------------------------------------------------------


def supplier_checks():
    return validation.Rules(
        checks={
            "lname_chk": text.like("lname", "[A-Z]%#[0-9]%"),
            "lnr_chk": F.col("lnr").between(1, 90),
            "status_chk": F.col("status").between(10, 80),
            "lstadt_chk": text.text_in("lstadt", *[f"NATION_{n}" for n in range(20)]),
            "nummer_chk": F.substring_index("lname", "#", -1).try_cast("int") >= 5,
            "paar_chk": ~((F.col("status") > 70) & text.same_text("lstadt", "NATION_3")),
        },
        required=("lnr", "lname", "status"),
    )


@query("d17_checks", """
    SELECT lnr, array_to_string(list_filter([
               CASE WHEN NOT lnr BETWEEN 1 AND 90 THEN 'lnr_chk' END,
               CASE WHEN NOT status BETWEEN 10 AND 80 THEN 'status_chk' END,
               CASE WHEN regexp_matches(lstadt, '^NATION_2[0-4]$') THEN 'lstadt_chk' END,
               CASE WHEN lnr < 5 THEN 'nummer_chk' END,
               CASE WHEN status > 70 AND lstadt = 'NATION_3' THEN 'paar_chk' END,
               CASE WHEN status IS NULL THEN 'status_null' END], lambda x : x IS NOT NULL), ',') AS verletzt
    FROM lieferant""")
def _(star):
    judged = validation.broken_checks(star.lieferant, supplier_checks())
    return judged.select("lnr", F.array_join("verletzt", ",").alias("verletzt"))


@query("d17_relative_date", """
    SELECT lnr, anr, ldatum FROM lieferung WHERE date_diff('day', ldatum, TIMESTAMP '2001-10-01') > 7""")
def _(star):
    today = F.lit(datetime(2001, 10, 1)).cast("timestamp_ntz")
    rules = validation.Rules(checks={"ldatum_chk": F.col("ldatum") >= today - F.expr("INTERVAL 7 DAYS")})
    judged = validation.broken_checks(star.lieferung, rules)
    return judged.filter(F.size("verletzt") > 0).select("lnr", "anr", "ldatum")


@query("d18_not_null", "SELECT lnr, 'status_null' AS verletzt FROM lieferant WHERE status IS NULL")
def _(star):
    judged = validation.broken_checks(star.lieferant, validation.Rules(required=("lnr", "lname", "status")))
    return judged.select("lnr", F.explode("verletzt").alias("verletzt"))


@query("d19_duplicate_keys", """
    SELECT DISTINCT lnr, anr, ldatum, anzahl FROM (
        SELECT *, count(*) OVER (PARTITION BY lnr, anr, ldatum) AS anzahl FROM lieferung) WHERE anzahl > 1""")
def _(star):
    return validation.duplicate_keys(star.lieferung, ("lnr", "anr", "ldatum"))


@query("d19_unique_with_null", """
    SELECT status, count(*) AS anzahl FROM lieferant GROUP BY status HAVING count(*) > 1""")
def _(star):
    return validation.duplicate_keys(star.lieferant, ("status",))


@query("d20_orphans", "SELECT lnr, anr, ldatum FROM lieferung ANTI JOIN lieferant USING (lnr)")
def _(star):
    key = validation.ForeignKey(("lnr",), star.lieferant, ("lnr",))
    return validation.orphans(star.lieferung, key).select("lnr", "anr", "ldatum")


@query("d20_unlabelled_documents", "SELECT doc_id, lang, source FROM documents ANTI JOIN labels USING (doc_id)")
def _(star):
    key = validation.ForeignKey(("doc_id",), star.raw("labels"), ("doc_id",))
    return validation.orphans(star.raw("documents").select("doc_id", "lang", "source"), key)


def document_checks(star):
    """Documents with a key that ignores letter case, and the labels as their parents."""
    return validation.Rules(
        checks={"n_chars_chk": F.col("n_chars").between(100, 5000), "lang_chk": text.text_in("lang", "EN", "DE", "FR")},
        required=("lang", "source"),
        keys={"laenge_ps": ("source", "n_chars")},
        foreign_keys={"label_fs": validation.ForeignKey(("doc_id",), star.raw("labels"), ("doc_id",))},
    )


def spelled_documents(star):
    rows = star.raw("documents").select("doc_id", "lang", "source", "n_chars")
    upper = F.concat(F.upper("source"), F.lit("  "))
    return rows.withColumn("source", F.when(F.col("doc_id") % 2 == 0, upper).otherwise(F.col("source")))


DOCUMENTS = """
    WITH urteil AS (
        SELECT doc_id, lang, CASE WHEN doc_id % 2 = 0 THEN upper(source) || '  ' ELSE source END AS source, n_chars,
               concat_ws(',', CASE WHEN n_chars NOT BETWEEN 100 AND 5000 THEN 'n_chars_chk' END,
                   CASE WHEN lang = 'es' THEN 'lang_chk' END,
                   CASE WHEN count(*) OVER (PARTITION BY source, n_chars) > 1 THEN 'laenge_ps' END,
                   CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'label_fs' END) AS verletzt FROM documents)"""


@query("d20_validated_documents_rejects", f"{DOCUMENTS} SELECT * FROM urteil WHERE verletzt <> ''")
def _(star):
    rejected = validation.validate(spelled_documents(star), document_checks(star))[1]
    return rejected.withColumn("verletzt", F.array_join("verletzt", ","))


@query("d20_validated_documents_accepted", f"""
    {DOCUMENTS} SELECT doc_id, lang, source, n_chars FROM urteil WHERE verletzt = ''""")
def _(star):
    return validation.validate(spelled_documents(star), document_checks(star))[0]


def delivery_checks(star):
    rules = validation.delivery_rules(star.lieferant, star.artikel)
    return validation.Rules({"lmenge_chk": F.col("lmenge").between(2, 49)}, rules.required, rules.keys, rules.foreign_keys)


JUDGED = """
    WITH urteil AS (
        SELECT *, concat_ws(',', CASE WHEN lmenge NOT BETWEEN 2 AND 49 THEN 'lmenge_chk' END,
                   CASE WHEN count(*) OVER (PARTITION BY lnr, anr, ldatum) > 1 THEN 'lief_ps' END,
                   CASE WHEN lnr NOT IN (SELECT lnr FROM lieferant) THEN 'lnr_fs' END,
                   CASE WHEN anr NOT IN (SELECT anr FROM artikel) THEN 'anr_fs' END) AS verletzt
        FROM lieferung)"""


@query("d20_validated_rejects", f"{JUDGED} SELECT * FROM urteil WHERE verletzt <> ''")
def _(star):
    rejected = validation.validate(star.lieferung, delivery_checks(star))[1]
    return rejected.withColumn("verletzt", F.array_join("verletzt", ","))


@query("d20_validated_accepted", f"{JUDGED} SELECT lnr, anr, lmenge, ldatum FROM urteil WHERE verletzt = ''")
def _(star):
    return validation.validate(star.lieferung, delivery_checks(star))[0]


def receipt_of(star):
    """The deliveries since 2000 arrive as a batch on top of the older ones."""
    older = star.lieferung.filter(~dates.since("ldatum", datetime(2000, 1, 1)))
    batch = star.lieferung.filter(dates.since("ldatum", datetime(2000, 1, 1)))
    return receipt.receive(
        star.lieferant, star.artikel, older, batch, 7, STAMP, F.lit("lager"), rules=delivery_checks(star)
    )


RECEIVED = f"""{JUDGED}, neu AS (
    SELECT anr, CAST(sum(lmenge) AS BIGINT) AS m FROM urteil
    WHERE verletzt = '' AND ldatum >= TIMESTAMP '2000-01-01' GROUP BY anr)"""


@query("d9_checked_receipt", f"""
    {RECEIVED} SELECT a.anr, aname, farbe, gewicht, astadt, CAST(amenge + coalesce(m, 0) AS BIGINT) AS amenge
    FROM artikel a LEFT JOIN neu ON neu.anr = a.anr""")
def _(star):
    return receipt_of(star).parts


@query("d8_receipt_log", f"""
    {RECEIVED} SELECT 7 AS lfdnr, TIMESTAMP '2002-01-15' AS wann, 'lager' AS wer, 'Update' AS was,
                      CAST(a.anr AS VARCHAR) AS primaerschluessel, CAST(amenge + m AS VARCHAR) AS neuer_wert,
                      CAST(amenge AS VARCHAR) AS alter_wert
    FROM artikel a JOIN neu ON neu.anr = a.anr""")
def _(star):
    return receipt_of(star).log


@query("d21_default", f"{SUPPLIER} UNION ALL {NEW}, 'Gotha' FROM customer")
def _(star):
    return changes.insert(star.lieferant, new_suppliers(star), defaults={"lstadt": "Gotha"})


@query("d21_null_given", f"{SUPPLIER} UNION ALL {NEW}, NULL FROM customer")
def _(star):
    rows = new_suppliers(star).withColumn("lstadt", F.lit(None).cast("string"))
    return changes.insert(star.lieferant, rows, defaults={"lstadt": "Gotha"})


def shifted_suppliers(star, by):
    moved = star.lieferant.filter(objects.at_place("NATION_3"))
    return moved.select(F.col("lnr").alias("old"), (F.col("lnr") + by).alias("new"))


def renamed_suppliers(star):
    moved = star.lieferant.filter(objects.at_place("NATION_3"))
    return moved.select(F.col("lnr").alias("old"), (F.col("lnr") + FIRST_NEW).alias("new"))


@query("d22_cascade_parent", f"""
    SELECT CASE lstadt WHEN 'NATION_3' THEN lnr + {FIRST_NEW} ELSE lnr END AS lnr, lname, status, lstadt FROM lieferant""")
def _(star):
    return changes.cascade_key(star.lieferant, renamed_suppliers(star), "lnr")


@query("d22_cascade_child", f"""
    SELECT lnr + CASE WHEN lnr IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) THEN {FIRST_NEW} ELSE 0 END AS lnr,
           anr, lmenge, ldatum FROM lieferung""")
def _(star):
    return changes.cascade_key(star.lieferung, renamed_suppliers(star), "lnr")


@query("d22_cascade_refused", "SELECT lnr, lname, status, lstadt FROM lieferant")
def _(star):
    return changes.checked_cascade(star.lieferant, shifted_suppliers(star, 1), "lnr")[0]


@query("d22_taken_keys", """
    WITH neu AS (SELECT lnr + 1 AS lnr FROM lieferant WHERE lstadt = 'NATION_3')
    SELECT lnr FROM neu WHERE lnr IN (SELECT lnr FROM lieferant WHERE lstadt <> 'NATION_3')""")
def _(star):
    return changes.checked_cascade(star.lieferant, shifted_suppliers(star, 1), "lnr")[1]


@query("d22_cascade_accepted", f"""
    SELECT CASE lstadt WHEN 'NATION_3' THEN lnr + {FIRST_NEW} ELSE lnr END AS lnr, lname, status, lstadt FROM lieferant""")
def _(star):
    return changes.checked_cascade(star.lieferant, shifted_suppliers(star, FIRST_NEW), "lnr")[0]


@query("d23_only_new_rows_checked", """
    SELECT lnr, anr, lmenge, ldatum FROM lieferung
    WHERE ldatum < TIMESTAMP '2000-01-01' OR lnr IN (SELECT lnr FROM lieferant)""")
def _(star):
    existing = star.lieferung.filter(F.col("ldatum") < F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz"))
    batch = star.lieferung.filter(dates.since("ldatum", datetime(2000, 1, 1)))
    key = validation.ForeignKey(("lnr",), star.lieferant, ("lnr",))
    accepted, _rejected = validation.validate(batch, validation.Rules(foreign_keys={"lnr_fs": key}))
    return existing.unionByName(accepted)


@query("d23_only_new_documents_checked", """
    SELECT doc_id, lang, source FROM documents WHERE lang <> 'en' OR doc_id IN (SELECT doc_id FROM labels)""")
def _(star):
    documents = star.raw("documents").select("doc_id", "lang", "source")
    english = text.same_text("lang", "EN")
    key = validation.ForeignKey(("doc_id",), star.raw("labels"), ("doc_id",))
    accepted, _rejected = validation.validate(documents.filter(english), validation.Rules(foreign_keys={"label_fs": key}))
    return documents.filter(~english).unionByName(accepted)


@query("d24_schema_change", "SELECT CAST(lnr AS VARCHAR) AS lnr, lname, status, CAST(NULL AS VARCHAR) AS vers_nr FROM lieferant")
def _(star):
    wider = changes.add_column(star.lieferant, "vers_nr", "string")
    return changes.retype_column(wider.drop("lstadt"), "lnr", "string")


@query("d25_history_copy", "SELECT lnr, anr, lmenge, ldatum FROM lieferung, range(2)")
def _(star):
    path = shared_folder(star.spark, "lieferung_hist")
    sinks.into_folder(star.lieferung, path)
    return sinks.append_to_folder(star.lieferung, path)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS tabellenname, count(*) AS anzahl_datensaetze FROM {name}" for name in TABLES
)


@query("d26_row_counts", ROW_COUNTS)
def row_counts(star):
    return changes.count_each({name: star.raw(name) for name in TABLES})


@query("e7_rows_per_table", ROW_COUNTS)
def _(star):
    return row_counts(star)


@query("d28_all_or_nothing", """
    WITH grenze AS (SELECT CASE WHEN max(status) + 5 > 99 THEN 0 ELSE 5 END AS punkte FROM lieferant)
    SELECT lnr, lname, CAST(status + punkte AS INTEGER) AS status, lstadt FROM lieferant, grenze""")
def _(star):
    staged = changes.update(star.lieferant, F.lit(True), status=F.col("status") + 5)
    path = shared_folder(star.spark, "lieferant_neu")
    published = sinks.publish_if(staged, path, lambda rows: rows["status"] > 99)
    return star.lieferant if published is None else published


@query("d28_published", "SELECT lnr, lname, CAST(status + 5 AS INTEGER) AS status, lstadt FROM lieferant")
def _(star):
    staged = changes.update(star.lieferant, F.lit(True), status=F.col("status") + 5)
    path = shared_folder(star.spark, "lieferant_neu")
    published = sinks.publish_if(staged, path, lambda rows: rows["status"] > 10000)
    return star.lieferant if published is None else published


# --- the research tables' rules on stored tables ------------------------------------------------


@query("e6_part_constraints", """
    SELECT anr, concat_ws(',', CASE WHEN farbe NOT IN ('red', 'blue', 'green', 'black', 'small') THEN 'farbe_chk' END,
           CASE WHEN amenge > 1000 THEN 'amenge_chk' END, CASE WHEN anr NOT BETWEEN 1 AND 150 THEN 'anr_chk' END) AS verletzt
    FROM artikel""")
def _(star):
    code = F.concat(F.lit("p"), F.col("anr").cast("string"))
    patterns = text.like(code, "p[1-9]") | text.like(code, "p[1-9][0-9]") | text.like(code, "p[1-9][0-9][0-9]")
    rules = validation.Rules(checks={
        "farbe_chk": text.text_in("farbe", "red", "blue", "green", "black", "small"),
        "amenge_chk": F.col("amenge").between(0, 1000),
        "anr_chk": patterns & F.substring(code, 2, 20).cast("long").between(1, 150),
    })
    judged = validation.broken_checks(star.artikel, rules)
    return judged.select("anr", F.array_join("verletzt", ",").alias("verletzt"))


# --- views, table functions, parameterised queries -----------------------------------------------


@query("q1_view", "SELECT s_suppkey AS lnr, s_name AS lname, 'NATION_3' AS lstadt FROM supplier WHERE s_nationkey = 3")
def _(star):
    return objects.suppliers_at(star, "NATION_3")


@query("q2_joined_view", f"{SUPPLIER.replace('lstadt', 'lstadt, anr, lmenge, ldatum')} JOIN lieferung USING (lnr)")
def _(star):
    return objects.deliveries_with_supplier(star)


def of_city(nation, year):
    return f"""
        SELECT l_suppkey AS lnr, s_name AS lname, 'NATION_{nation}' AS lstadt, l_shipdate AS ldatum, p_name AS aname
        FROM lineitem, supplier, part
        WHERE s_suppkey = l_suppkey AND p_partkey = l_partkey AND s_nationkey = {nation} AND year(l_shipdate) = {year}"""


@query("q3_three_way_view", of_city(3, 1998))
def _(star):
    return objects.deliveries_of(star, "NATION_3", 1998)


@query("q4_table_function", of_city(11, 2000))
def _(star):
    return objects.deliveries_of(star, place="NATION_11", year=2000)


@query("q5_suppliers", "SELECT lnr AS nummer, lname AS namen, lstadt AS orte FROM lieferant")
def _(star):
    return objects.number_name_place(star)


@query("q5_parts_filtered", "SELECT anr AS nummer, aname AS namen, astadt AS orte FROM artikel WHERE contains(aname, 'e')")
def _(star):
    return objects.number_name_place(star, "artikel").filter(text.like("namen", "%e%"))


@query("q5_unknown_table", "SELECT lnr AS nummer, lname AS namen, lstadt AS orte FROM lieferant WHERE FALSE")
def _(star):
    return objects.number_name_place(star, "unbekannt")


MONTH = """SELECT lnr AS lieferantennummer, lname AS lieferantenname, aname AS artikelname,
               strftime(ldatum, '%d.%m.%Y') AS lieferdatum
           FROM lieferung JOIN lieferant USING (lnr) JOIN artikel USING (anr) WHERE month(ldatum) ="""


@query("q6_month_by_number", f"{MONTH} 8")
def _(star):
    return objects.deliveries_in_month(star, "8")


@query("q6_month_by_name", f"{MONTH} 7")
def _(star):
    return objects.deliveries_in_month(star, "Juli")


@query("q7_scalar_functions", """
    SELECT lnr, anr, ldatum, week(ldatum)::INTEGER AS woche, concat(day(ldatum), '/', month(ldatum), '/', year(ldatum)) AS datum,
           lnr * 1000 + anr BETWEEN 10000 AND 99999 AS gueltig FROM lieferung""")
def _(star):
    code = (F.col("lnr") * 1000 + F.col("anr")).cast("string")
    return star.lieferung.select(
        "lnr", "anr", "ldatum", objects.OBJECTS["isowoche"]("ldatum").alias("woche"),
        objects.OBJECTS["fk_datsep"]("ldatum", "/").alias("datum"),
        objects.OBJECTS["fk_plzvalid"](code).alias("gueltig"),
    )


@query("q8_parts_by_colour", "SELECT anr, aname, astadt FROM artikel WHERE aname LIKE 'red %'")
def _(star):
    return objects.OBJECTS["farb_art"](star, "red")


@query("q10_looked_up_place", """
    SELECT b.anr, b.aname, b.amenge, a.astadt AS ort, a.farbe FROM artikel a JOIN artikel b ON a.astadt = b.astadt
    WHERE a.anr = 3""")
def _(star):
    return objects.parts_at_place_of(star, 3)


@query("q9_ratio_per_line", """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(l_tax, 0), 4) AS quotient,
           CAST(l_tax = 0 AS INTEGER) * 8 AS rueckgabe FROM lineitem""")
def _(star):
    return star.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.round(numbers.ratio("l_extendedprice", "l_tax"), 4).alias("quotient"),
        numbers.ratio_status("l_tax").alias("rueckgabe"),
    )
