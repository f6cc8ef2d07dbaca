"""Table changes, audit, routing and constraints."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotflow.operators import audit, changes, receipt, stock, validation
from depotflow.plans import jobs, objects
from depotflow.sources import schema, star as model


def supplier(star, *rows):
    return model.supplier_rows(star.spark, rows)


def named(star, **columns):
    return star.spark.createDataFrame([tuple(columns.values())], list(columns))


def test_insert(star, rows):
    table = star.lieferant
    by_name = changes.insert(table, named(star, lstadt="Bremen", lnr="L21", status=5, lname="Dahl"))
    assert rows(by_name)[-1] == ("L21", "Dahl", 5, "Bremen")
    short = changes.insert(table, named(star, lnr="L23", lname="Ebert"))
    assert rows(short)[-1] == ("L23", "Ebert", None, None)
    defaulted = changes.insert(table, named(star, lnr="L08", lname="Falk", status=5), {"lstadt": "Gotha"})
    assert rows(defaulted)[-1] == ("L08", "Falk", 5, "Gotha")
    explicit = changes.insert(table, supplier(star, ("L09", "Gerber", 5, None)), {"lstadt": "Gotha"})
    assert rows(explicit)[-1] == ("L09", "Gerber", 5, None)
    with pytest.raises(ValueError):
        changes.insert(table, named(star, lnr="L06", unknown=0))
    with pytest.raises(ValueError):
        changes.insert_by_position(table, named(star, a="L06", b="Heller", c=5, d="Kiel", e=0))
    assert changes.insert_by_position(table, named(star, a="L06", b="Heller", c=5, d="Kiel")).count() == 6
    # A text in the place of a number is an error, not a silent NULL.
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        changes.insert_by_position(table, named(star, a="Kiel", b="L22", c="Ihle", d=5)).collect()


def test_insert_numbered(star, rows):
    staff = star.spark.createDataFrame([], "m_nr bigint, m_name string")
    first = changes.insert_numbered(staff, star.lieferant.select(F.col("lname").alias("m_name")), "m_nr", [F.col("m_name")])
    assert rows(first) == [(1000, "Adam"), (1001, "Blank"), (1002, "Clark"), (1003, "Jonas"), (1004, "Schmidt")]
    more = changes.insert_numbered(first, first.filter("m_nr < 1002").select("m_name"), "m_nr", [F.col("m_name").desc()])
    assert rows(more)[5:] == [(1005, "Blank"), (1006, "Adam")]


def test_update_and_delete(star, rows):
    table = star.lieferant.union(supplier(star, ("L22", "Ida", 5, None)))
    moved = changes.update(table, F.col("lnr") == "L22", lstadt=F.lit("Gotha"))
    assert rows(moved)[-1] == ("L22", "Ida", 5, "Gotha")
    # Unknown is not true: the row without a place is neither updated nor deleted.
    assert changes.update(table, F.col("lstadt") != "Aachen", status=F.lit(1)).filter("status = 1").count() == 4
    assert rows(changes.delete(table, F.col("lstadt") != "Aachen"), "lnr") == [("L05",), ("L22",)]
    raised = jobs.raise_status(star, more_than=2, points=5)
    assert rows(raised, "lnr", "status") == [("L01", 25), ("L02", 10), ("L03", 30), ("L04", 25), ("L05", 30)]
    left = changes.delete_unmatched(table, star.lieferung, "lnr", spared=F.col("lnr") == "L05")
    assert rows(left, "lnr") == [("L01",), ("L02",), ("L03",), ("L04",), ("L05",)]
    empty = changes.truncate(table)
    assert empty.count() == 0 and empty.schema == table.schema
    # All new values come from the old row.
    swapped = changes.update(table, F.lit(True), lname=F.col("lstadt"), lstadt=F.col("lname"))
    assert rows(swapped)[0] == ("L01", "Hamburg", 20, "Schmidt")


def test_audit(star, rows):
    when = datetime(2022, 6, 30, 12)
    table = star.lieferant
    after = changes.insert(table, named(star, lnr="L24", lname="Fink", status=5, lstadt="Bremen"))
    three, five = F.col("lnr") == "L03", F.col("lnr") == "L05"
    moved = audit.updated(table, three, "lnr", lstadt=F.lit("Jena"))
    log = audit.stamped(audit.inserted(after.filter("lnr = 'L24'"), "lnr"), moved, audit.deleted(table, five, "lnr"),
                        number=2, when=when, who=F.lit("ich"))
    assert log.columns == schema.SPION.names
    assert rows(log, "was", "primaerschluessel", "neuer_wert", "alter_wert") == [
        ("Delete", "L05", None, "L05"), ("Insert", "L24", "L24", None), ("Update", "L03", "Jena", "Ludwigshafen")]
    assert rows(log, "lfdnr", "wann", "wer")[0] == (2, when, "ich")
    # A row that is hit is logged even where its value stays, and once for each audited column.
    same = audit.stamped(audit.updated(table, three, "lnr", lstadt=F.col("lstadt")), number=1, when=when)
    assert rows(same, "was", "neuer_wert", "alter_wert") == [("Update", "Ludwigshafen", "Ludwigshafen")]
    unknown = audit.updated(table, F.col("lnr") == "L01", "lnr", lstadt=F.lit(None), status=F.col("status") + 1)
    both = audit.stamped(unknown, number=1, when=when, columns=True)
    assert rows(both, "spalte", "neuer_wert", "alter_wert") == [("lstadt", None, "Hamburg"), ("status", "21", "20")]
    assert audit.stamped(audit.deleted(table, F.lit(False), "lnr"), number=1, when=when).count() == 0


def test_stock_edges(star):
    levels = lambda parts: {r.anr: r.amenge for r in parts.collect()}
    twice = model.delivery_rows(star.spark, [
        ("L01", "A01", 10, "2022-01-01"), ("L02", "A01", 5, "2022-01-01"), ("L02", "A99", 5, "2022-01-01")])
    assert levels(stock.maintain_stock(star.artikel, inserted=twice)) == {**levels(star.artikel), "A01": 815}
    assert levels(stock.maintain_stock(star.artikel, inserted=twice.limit(0))) == levels(star.artikel)
    quantity = twice.withColumn("lmenge", F.col("lmenge") + 1)
    assert levels(stock.maintain_stock(star.artikel, inserted=quantity, deleted=twice))["A01"] == 802
    unknown = changes.update(star.artikel, F.col("anr") == "A01", amenge=F.lit(None))
    assert levels(stock.maintain_stock(unknown, inserted=twice))["A01"] is None
    with pytest.raises(ValueError):
        stock.stock_delta()
    # The stock rule is checked on the new version.
    much = model.delivery_rows(star.spark, [("L01", "A01", 9999, "2022-01-01")])
    broken = validation.validate(stock.maintain_stock(star.artikel, inserted=much), validation.part_rules())[1]
    assert [(r.anr, r.verletzt) for r in broken.collect()] == [("A01", ["amenge_chk"])]


def test_receipt(star, rows):
    batch = model.delivery_rows(star.spark, [
        ("L03", "A06", 500, "2022-06-30"), ("L44", "A06", 1, "2022-06-30"), ("L01", "A01", 9, "1990-05-18")])
    done = receipt.receive(star.lieferant, star.artikel, star.lieferung, batch, 3, datetime(2022, 6, 30), F.lit("ich"))
    assert rows(done.accepted, "lnr", "anr") == [("L03", "A06")]
    assert verdicts(done.rejected) == {"L44": ["lnr_fs"], "L01": ["lief_ps"]}
    assert done.deliveries.count() == 13
    assert rows(done.parts.filter("anr = 'A06'"), "amenge") == [(1000,)]
    assert rows(done.log, "was", "primaerschluessel", "neuer_wert", "alter_wert") == [("Update", "A06", "1000", "500")]


def test_keys_ignore_letter_case(star, rows):
    """A delivery of l01 belongs to L01, and a new supplier l01 does not fit beside it."""
    batch = model.delivery_rows(star.spark, [("l01 ", "a02", 5, "2022-06-30"), ("L77", "A02", 5, "2022-06-30")])
    rules = validation.delivery_rules(star.lieferant, star.artikel)
    accepted, rejected = validation.validate(batch, rules, existing=star.lieferung)
    assert rows(accepted, "lnr") == [("l01 ",)] and verdicts(rejected) == {"L77": ["lnr_fs"]}
    key = validation.ForeignKey(("lnr",), star.lieferant, ("lnr",))
    assert rows(validation.orphans(batch, key), "lnr") == [("L77",)]
    again = supplier(star, ("l01", "Klein", 5, "Jena"), ("L55", "Gross", 5, "Jena"), ("l55 ", "Gross", 5, "Jena"))
    _taken, refused = validation.validate(again, validation.supplier_rules(), existing=star.lieferant)
    assert verdicts(refused) == {"l01": ["lnr_ps"], "L55": ["lnr_ps"], "l55 ": ["lnr_ps"]}
    assert rows(validation.duplicate_keys(again, ("lnr",))) == [("L55", 2)]


def test_stock_rule(star, rows):
    """A change after which a part's stock is outside its bounds changes nothing."""
    much = model.delivery_rows(star.spark, [("L01", "A01", 5000, "2022-01-01"), ("L01", "A02", 1, "2022-01-01")])
    table, broken = stock.checked_stock(star.artikel, stock.stock_delta(deleted=much))
    assert rows(broken, "anr", "amenge") == [("A01", -4200)]
    assert rows(table, "anr", "amenge") == rows(star.artikel, "anr", "amenge")
    table, broken = stock.checked_stock(star.artikel, stock.stock_delta(inserted=much))
    assert broken.count() == 0 and rows(table.filter("anr IN ('A01', 'A02')"), "amenge") == [(1201,), (5800,)]
    # A total beyond INT is a part that breaks the rule, not the end of the job.
    huge = stock.stock_delta(inserted=star.spark.createDataFrame([("A01", 2**31 - 1)] * 3, "anr string, lmenge int"))
    assert rows(stock.checked_stock(star.artikel, huge)[1], "amenge") == [(3 * (2**31 - 1) + 800,)]
    done = receipt.receive(star.lieferant, star.artikel, star.lieferung, much.withColumn("lmenge", F.lit(9500)), 1,
                           datetime(2022, 1, 1))
    assert not done.published and done.deliveries.count() == 12 and done.log.count() == 0
    assert rows(done.parts, "anr", "amenge") == rows(star.artikel, "anr", "amenge") and done.broken.count() == 2


def test_unknown_changes_are_rejected(star, rows):
    feed = star.spark.createDataFrame(
        [("Insert", "A01", 5), ("insert", "A01", 7), ("Update", "A01", 9), (None, "A01", 1), ("Insert", None, 1),
         ("Delete", "A02", None)], "was string, anr string, lmenge int")
    booked, refused = stock.split_changes(feed)
    assert rows(stock.delta_of_changes(booked)) == [("A01", 5)]
    assert rows(refused, "grund") == [("anr",), ("lmenge",), ("was",), ("was",), ("was",)]
    with pytest.raises(Exception, match="no stock change"):
        stock.delta_of_changes(feed).collect()


def test_two_new_keys_for_one_stop(star):
    renamed = star.spark.createDataFrame([("L01", "L71"), ("L01", "L72"), ("L02", "L73")], "old string, new string")
    with pytest.raises(Exception, match="two new keys for L01"):
        changes.cascade_key(star.lieferung, renamed, "lnr").collect()


def test_routing(star, rows):
    feed = star.spark.createDataFrame([
        ("L10", "Ihle", 10, "Erfurt", "A03", 500, datetime(2022, 6, 30)),
        ("L10", "Ihle", 10, "Erfurt", "A04", 100, datetime(2022, 6, 30)),
        ("L01", "Schmidt", 20, "Hamburg", "A03", 500, datetime(2022, 6, 30)),
    ], "lnr string, lname string, status int, lstadt string, anr string, lmenge int, ldatum timestamp_ntz")
    # A known supplier in the batch does not keep the new one out.
    suppliers, deliveries = changes.route_joined_feed(feed, star.lieferant, star.lieferung, "lnr")
    assert rows(suppliers) == [("L10", "Ihle", 10, "Erfurt")]
    assert deliveries.count() == 3 and deliveries.columns == star.lieferung.columns
    refused = changes.refuse_all(star.artikel, "gesperrt")
    assert refused.count() == 6 and refused.first()["grund"] == "gesperrt"


def test_views(star, rows):
    at_city = objects.at_place("Hamburg")
    batch = supplier(star, ("L31", "Dorn", None, "Bremen"), ("L32", "Ebel", None, "Hamburg"), ("L33", "Ida", None, None))
    accepted, refused = changes.split_by_view(batch, at_city)
    assert rows(accepted, "lnr") == [("L32",)] and rows(refused, "lnr") == [("L31",), ("L33",)]
    table = star.lieferant.union(batch)
    assert rows(objects.suppliers_at(star.with_tables(lieferant=table)), "lnr") == [("L01",), ("L04",), ("L32",)]
    same, lost = changes.checked_view_update(table, at_city, F.col("lnr") == "L32", lstadt=F.lit("Erfurt"))
    assert rows(same) == rows(table) and rows(lost, "lnr", "lstadt") == [("L32", "Erfurt")]
    renamed, lost = changes.checked_view_update(table, at_city, F.col("lnr") == "L32", lname=F.lit("Neuer Name"))
    assert rows(renamed.filter("lnr = 'L32'"), "lname") == [("Neuer Name",)] and lost.count() == 0
    outside = changes.update_through_view(table, at_city, F.col("lnr") == "L02", lname=F.lit("x"))
    assert rows(outside) == rows(table)
    left = changes.delete_through_view(table, at_city, star.lieferung, "lnr")
    assert rows(left, "lnr") == [("L01",), ("L02",), ("L03",), ("L04",), ("L05",), ("L31",), ("L33",)]


def test_schema_changes(star):
    wider = changes.add_column(star.lieferant, "vers_nr", "string")
    assert wider.schema["vers_nr"].dataType.simpleString() == "string" and wider.filter("vers_nr IS NOT NULL").count() == 0
    assert changes.retype_column(star.lieferant, "status", "bigint").schema["status"].dataType.simpleString() == "bigint"
    counts = {r.tabellenname: r.anzahl_datensaetze for r in changes.count_each(
        {"lieferant": star.lieferant, "artikel": star.artikel, "lieferung": star.lieferung}).collect()}
    assert counts == {"lieferant": 5, "artikel": 6, "lieferung": 12}


def verdicts(rejected, key="lnr"):
    return {r[key]: sorted(r["verletzt"]) for r in rejected.collect()}


@pytest.fixture(params=["-1", "10485760"], ids=["shuffled", "broadcast"])
def few_keys(request, spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


def test_model_rules(star, few_keys):
    for table, rules in ((star.lieferant, validation.supplier_rules()), (star.artikel, validation.part_rules()),
                         (star.lieferung, validation.delivery_rules(star.lieferant, star.artikel))):
        accepted, rejected = validation.validate(table, rules)
        assert accepted.count() == table.count() and rejected.count() == 0
    batch = star.spark.createDataFrame([
        ("L10", "8Opal", 5, "Jena"), ("L11", "Opal", 105, "Erfurt"), ("l12", "opal", None, None), ("X13", "Opal", 5, "Erfurt"),
        ("L00", "Opal", 5, "Erfurt"), ("Lab", "Opal", 5, "Erfurt"), ("L14", None, 5, "99"), ("L01", "Heller", 5, "Erfurt"),
        ("L15", "Zwei", 5, "Erfurt"), ("L15", "Zweiter", 5, "Erfurt"), (None, "Namenlos", 5, "Erfurt"),
    ], "lnr string, lname string, status int, lstadt string")
    accepted, rejected = validation.validate(batch, validation.supplier_rules(), existing=star.lieferant)
    assert [r.lnr for r in accepted.collect()] == ["l12"]
    assert verdicts(rejected) == {
        "L10": ["lname_chk"], "L11": ["status_chk"], "X13": ["lnr_chk"], "L00": ["lnr_chk"], "Lab": ["lnr_chk"],
        "L14": ["lname_null", "lstadt_chk"], "L01": ["lnr_ps"], "L15": ["lnr_ps"], None: ["lnr_null"]}
    assert rejected.count() == 10


def test_delivery_rules(star, few_keys):
    batch = star.spark.createDataFrame([
        ("L44", "A02", 500, datetime(2022, 1, 1)), ("L01", "A77", 1, datetime(2022, 1, 1)),
        ("L01", "A01", 0, datetime(2022, 1, 1)), ("L01", "A01", 7, datetime(1990, 5, 18)),
        (None, "A01", 7, datetime(2022, 1, 2)), ("L02", "A06", 7, datetime(2022, 1, 2)),
    ], "lnr string, anr string, lmenge int, ldatum timestamp_ntz")
    accepted, rejected = validation.validate(
        batch, validation.delivery_rules(star.lieferant, star.artikel), existing=star.lieferung)
    assert [r.anr for r in accepted.collect()] == ["A06"]
    found = sorted((r.lnr or "", r.anr, r.lmenge, tuple(r.verletzt)) for r in rejected.collect())
    assert found == [("", "A01", 7, ("lnr_null",)), ("L01", "A01", 0, ("lmenge_chk",)), ("L01", "A01", 7, ("lief_ps",)),
                     ("L01", "A77", 1, ("anr_fs",)), ("L44", "A02", 500, ("lnr_fs",))]
    key = validation.ForeignKey(("lnr",), star.lieferant, ("lnr",))
    assert [r.lnr for r in validation.orphans(batch, key).collect()] == ["L44"]


def test_unique_counts_null_as_one_value(star):
    df = star.spark.createDataFrame([("x", None), ("y", None), ("z", "1")], "k string, u string")
    assert [(r.u, r.anzahl) for r in validation.duplicate_keys(df, ("u",)).collect()] == [(None, 2)]
    assert validation.full_name_check("lname", "vname") is not None
    names = star.spark.createDataFrame([(None, "Bernd"), ("Kunz", None), (None, None)], "n string, v string")
    judged = validation.broken_checks(names, validation.Rules(checks={"name_chk": validation.full_name_check("n", "v")}))
    assert [r.verletzt for r in judged.collect()] == [["name_chk"], [], []]
    assert validation.broken_checks(names, validation.Rules()).filter("size(verletzt) > 0").count() == 0


@pytest.fixture(scope="module")
def research(spark):
    today = date(2022, 6, 30)
    make = spark.createDataFrame
    tables = {
        "orte": make([(1, "20095", "Hamburg"), (2, "50667", "Köln"), (3, "28195", "Bremen"), (4, "24103", "Kiel"),
                      (5, "18055", "Rostock"), (6, "04109", "Leipzig"), (7, "45127", "Essen")], schema.ORTE),
        "abteilung": make([("a1", "Versuche", 1)], schema.ABTEILUNG),
        "projekt": make([("p1", "Windkanal", Decimal(40000))], schema.PROJEKT),
        "mitarbeiter": make([(1000, "Ahrens", "Jule", 1, "Am Deich 7", date(1990, 2, 3), "a1")], schema.MITARBEITER),
        "arbeiten": make([(1000, "p1", "Messung", today)], schema.ARBEITEN),
        "telefon": make([(1000, "040", "112233")], schema.TELEFON),
    }
    return tables, validation.research_rules(tables, today), today


def test_research_rows_are_valid(research):
    tables, rules, _today = research
    for name, table in tables.items():
        assert validation.validate(table, rules[name])[1].count() == 0, name


def test_research_rules(spark, research):
    tables, rules, _today = research

    def bad(name, key, *rows):
        batch = spark.createDataFrame(list(rows), tables[name].schema)
        return verdicts(validation.validate(batch, rules[name], existing=tables[name])[1], key)

    assert bad("abteilung", "abt_nr", ("a50", "X", 7), ("a51", "X", 7), ("a0", "X", 7), ("b1", "X", 7), ("a2", "1X", 9)) == {
        "a51": ["abt_nr_chk"], "a0": ["abt_nr_chk"], "b1": ["abt_nr_chk"], "a2": ["abt_name_chk", "aortid_chk", "aortid_fs"]}
    assert bad("projekt", "pr_nr", ("p150", "X", Decimal(1)), ("p151", "X", Decimal(1)), ("p2", "X", Decimal(0)),
               ("p1", "X", Decimal(5))) == {"p151": ["pr_nr_chk"], "p2": ["mittel_chk"], "p1": ["pr_nr_ps"]}
    assert bad("orte", "ortid", (8, "20095", "Hamburg"), (9, None, None)) == {8: ["orte_unq"]}
    assert bad("mitarbeiter", "m_nr", (1001, "Ost", None, 8, None, None, None), (1002, "Ost", "5", 1, None, None, "a9")) == {
        1001: ["mortid_fs"], 1002: ["abt_nr_fs", "m_vorname_chk"]}
    assert bad("arbeiten", "m_nr", (1000, "p1", None, date(2022, 6, 23)), (1001, "p1", "x", date(2022, 6, 22))) == {
        1000: ["arbeiten_ps"], 1001: ["einst_dat_chk", "m_nr_fs"]}
    assert bad("telefon", "tel_nr", (1001, "030", "1"), (1000, "040", "112233")) == {"1": ["m_nr_fk"], "112233": ["tel_ps"]}
