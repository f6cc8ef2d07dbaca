"""Answers on the sample data set, worked out by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from depotflow.functions import dates, numbers, text
from depotflow.operators import changes, division, grouping, joins, membership, numbering, stock
from depotflow.plans import exercises as ex, joins as joined, objects, selections, summaries
from depotflow.plans.scans import delivery_ages, delivery_sentences, deliveries_per_supplier
from depotflow.sources import star as model

RED_BLUE = ("rot", "blau")


def test_figures(star):
    row = summaries.delivery_figures(star).first()
    assert tuple(row)[:3] == (3100, 400, 100)
    assert row["mittel"] == pytest.approx(3100 / 12) and row["anzahl"] == 12


def test_group_results(star, rows):
    largest = star.lieferung.groupBy("lnr").agg(F.max("lmenge"))
    assert rows(largest) == [("L01", 400), ("L02", 400), ("L03", 200), ("L04", 400)]
    assert rows(summaries.status_by_place(star.lieferant, 15)) == [("Aachen", 30), ("Hamburg", 20), ("Ludwigshafen", 30)]
    assert rows(ex.distinct_parts(star)) == [("L01", 6), ("L02", 2), ("L03", 1), ("L04", 3)]
    assert rows(ex.large_suppliers_since(star, dates.german("13.07.1990"), 600)) == [("L02", 700), ("L04", 900)]
    # Places at or below the lower bound drop out.
    assert rows(ex.status_bounds(star.lieferant, 10, 50)) == [("Aachen", 30, 30), ("Hamburg", 20, 20)]


def test_counts(star, values):
    assert values(ex.rarely_delivered(star, 3)) == ["A01", "A03", "A04", "A05", "A06"]
    assert ex.count_in_month(star, 8).first()[0] == 7
    assert star.lieferung.select("lnr").distinct().count() == 4
    weight = star.artikel.agg(F.max(numbers.kilograms("gewicht") * F.col("amenge"))).first()[0]
    assert float(weight) == 20.4
    average = star.lieferung.agg(numbers.whole_average("lmenge")).first()[0]
    assert average == 258


def test_ranks(star, rows):
    ranked = summaries.supplier_ranks(star)
    assert rows(ranked, "lnr", "gesamtliefermenge", "rang") == [
        ("L01", 1300, 1), ("L02", 700, 3), ("L03", 200, 4), ("L04", 900, 2)]
    more = model.delivery_rows(star.spark, [("L02", "A04", 200, "2022-06-03"), ("L05", "A01", 900, "2022-06-03")])
    tied = summaries.supplier_ranks(star.with_tables(lieferung=star.lieferung.union(more)))
    assert rows(tied, "lnr", "rang", "rang_dicht") == [
        ("L01", 1, 1), ("L02", 2, 2), ("L03", 5, 3), ("L04", 2, 2), ("L05", 2, 2)]


def test_subtotals(star):
    monthly = summaries.by_month(star, 100)
    keys = ["lnr", "monat", "jahr"]
    assert grouping.rollup_sum(monthly, keys, "lmenge", "summe").count() == 19
    cube = grouping.cube_sum(monthly, keys, "lmenge", "summe")
    assert cube.count() == 32
    assert cube.filter("ebene = 7").first()["summe"] == 3100


def test_total_differs_from_unknown_key(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    found = {(r.k, r.ebene): r.s for r in grouping.rollup_sum(df, ["k"], "v", "s").collect()}
    assert found == {(None, 0): 1, ("a", 0): 2, (None, 1): 3}


def test_places(star, values):
    assert values(selections.all_places(star)) == ["Aachen", "Hamburg", "Ludwigshafen", "Mannheim"]
    living, storing = selections.places(star)
    assert living.union(storing).count() == 11
    assert values(living.subtract(storing)) == ["Aachen"]
    assert values(living.intersect(storing)) == ["Hamburg", "Ludwigshafen"]
    assert values(membership.not_in(ex.living_places(star), "lstadt", star.artikel, "astadt")) == ["Aachen"]


def test_joins(star, rows, values):
    sizes = star.spark.range(1).select(
        membership.product_size(star.lieferant, star.lieferung),
        membership.product_size(star.lieferant, star.lieferung, star.artikel),
    ).first()
    assert tuple(sizes) == (60, 360)
    unequal = membership.count_unequal(star.lieferant, star.lieferung, "lnr", "n")
    assert unequal.agg(F.sum("n")).first()[0] == 48
    assert values(membership.not_matched(star.lieferant, star.lieferung, "lnr").select("lnr")) == ["L05"]
    assert joins.left_from_dimension(star.lieferant, star.lieferung, "lnr").count() == 13
    pairs = rows(joins.partners_by_group(star.artikel.select("astadt", "anr"), "astadt", "anr"), "anr", "position", "partner")
    assert pairs == [("A01", 1, 2), ("A02", 1, 1), ("A03", 1, 0), ("A04", 2, 1), ("A05", 2, 0), ("A06", 3, 0)]
    same = rows(joined.delivered_where_stored(star), "anr", "lnr")
    assert same == [("A01", "L01"), ("A02", "L02"), ("A02", "L03"), ("A04", "L01"), ("A04", "L04"), ("A06", "L01")]
    assert rows(joined.same_place(star), "anr", "lieferanten") == [
        ("A01", 2), ("A02", 2), ("A04", 2), ("A05", 2), ("A06", 2)]


def test_orphan_delivery(star, rows):
    orphan = model.delivery_rows(star.spark, [("L33", "A05", 500, "2022-06-15")])
    deliveries = star.lieferung.union(orphan)
    full = joins.full_outer(star.lieferant, deliveries, "lnr")
    assert full.count() == 14
    assert rows(full.filter("lname IS NULL"), "lnr", "anr") == [("L33", "A05")]
    assert rows(full.filter("anr IS NULL"), "lnr", "lname") == [("L05", "Adam")]
    expected = star.lieferant.join(deliveries, "lnr", "full")
    assert rows(full, *expected.columns) == rows(expected)


def test_division(star, values):
    assert values(ex.suppliers_of_every_part(star).select("lnr")) == ["L01"]
    assert values(division.covers_all_of(star.lieferung, "lnr", "anr", "L02")) == ["L01"]
    # Nothing to cover: everyone does, the same as two nested NOT EXISTS.
    assert values(division.covers_all_of(star.lieferung, "lnr", "anr", "L05")) == ["L01", "L02", "L03", "L04"]


def test_subqueries(star, values):
    first = lambda df: values(df.select(df.columns[0]))
    assert first(ex.last_delivered_with(star, "A02")) == ["A02"]
    assert first(ex.above_average_of_city(star, "L02")) == ["L03", "L05"]
    low = summaries.below_average_of(star.lieferung, "A03")
    assert first(low) == ["A01", "A02", "A04", "A05", "A06"]
    assert first(ex.not_delivering(star, "A05")) == ["L02", "L03", "L05"]
    assert first(ex.parts_of_busy_suppliers(star, 1990, 8, 3)) == ["A02", "A04", "A05"]
    assert first(ex.repeated_parts_of_busy_suppliers(star, 2, 2)) == ["A02", "A04", "A05"]
    assert first(joined.frequent_suppliers(star, 3)) == ["L01", "L04"]
    assert first(joined.suppliers_where_stored(star, "A04")) == ["L01", "L04"]
    assert first(joined.coloured_deliverers(star, "Hamburg", RED_BLUE, dates.german("01.08.90"))) == ["L04"]
    assert joined.coloured_deliveries(star, "Hamburg", RED_BLUE).count() == 7
    assert first(joined.stored_with(star, "A01")) == ["A04", "A06"]
    assert first(ex.sharing_a_part_with(star, "L03")) == ["L01", "L02", "L04"]
    assert first(ex.several_parts(star)) == ["L01", "L02", "L04"]
    assert first(ex.status_below(star, "L03")) == ["L01", "L02", "L04"]
    assert first(ex.above_lowest_status(star)) == ["L01", "L03", "L04"]
    assert sorted(r[0] for r in ex.places_of_parts(star, "L02").collect()) == ["Hamburg", "Ludwigshafen"]
    assert len(first(ex.delivered_parts(star))) == 6


@pytest.mark.parametrize("how", ["exists", "in", "join"])
def test_three_spellings_agree(star, values, how):
    assert values(ex.that_delivered(star, star.lieferung, how).select("lnr")) == ["L01", "L02", "L03", "L04"]


@pytest.mark.parametrize("how", ["between", "in", "compare"])
def test_two_days(star, rows, how):
    found = ex.deliveries_on_two_days(star, dates.german("05.08.1990"), how)
    assert rows(found, "lnr", "anr") == [("L02", "A02"), ("L03", "A02")]


def test_city_deliveries(star):
    moment = dates.german("05.05.1990")
    assert ex.count_city_deliveries_since(star, "Hamburg", moment).first()[0] == 8
    assert ex.city_deliveries_since(star, "hamburg", moment).count() == 8


def test_filters(star, values):
    found = ex.coloured_or_stocked(star, "Hamburg", RED_BLUE, 900, 1500).select("anr")
    assert values(found) == ["A01", "A04", "A06"]
    extra = model.supplier_rows(star.spark, [
        ("L10", "Schul%ze", None, None), ("L20", "Braun", 5, "Riedhausen"), ("L21", "Brand", 5, "Erfurt"),
        ("L22", "Graf", 5, "Erfurt"),
    ])
    suppliers = star.lieferant.union(extra)
    found = ex.named_and_not_living(suppliers, "[BCS]_a%_", "ried").select("lname")
    assert values(found) == ["Blank", "Brand", "Clark"]
    assert values(suppliers.filter(text.like("lname", "%y%%", escape="y")).select("lname")) == ["Schul%ze"]
    assert suppliers.filter(F.col("lstadt") == F.lit(None)).count() == 0
    # Jonas is behind J, and in front of Jz.
    assert "Jonas" not in values(suppliers.filter(text.text_between("lname", "B", "J")).select("lname"))
    assert "Jonas" in values(suppliers.filter(text.text_between("lname", "B", "Jz")).select("lname"))
    assert values(suppliers.filter(text.text_between("lname", "A", "G")).select("lnr")) == ["L03", "L04", "L05", "L20", "L21"]
    assert values(suppliers.filter(text.like("lname", "[a-g]%")).select("lnr")) == ["L03", "L04", "L05", "L20", "L21", "L22"]
    parts = star.artikel.union(model.part_rows(star.spark, [
        ("A11", "Kupplung", "rot", None, "Riedhausen", 100), ("A12", "Lager", "blau", 0, "Oberried", 1200)]))
    assert values(ex.weight_zero_or_unknown(parts).select("anr")) == ["A11", "A12"]


def test_sentences(star):
    sentences = {(r.artikelnummer, r.lieferdatum) for r in delivery_sentences(star).collect()}
    assert ("A01", "Freitag der 18. Mai 1990") in sentences
    moment = F.lit(datetime(2022, 6, 1)).cast("timestamp_ntz")
    ages = {(r.artikelnummer, r.lieferdatum, r.die_lieferung) for r in delivery_ages(star, moment).collect()}
    # 11702 days are 32 years of 365 days; 11702 % 365.25 = 14 days.
    assert ("A01", "18.05.1990", "vor 32 Jahren und 0 Monaten.") in ages


def test_objects(star, rows, values):
    assert rows(objects.suppliers_at(star)) == [("L01", "Schmidt", "Hamburg"), ("L04", "Clark", "Hamburg")]
    assert objects.deliveries_with_supplier(star).count() == 12
    assert objects.deliveries_of(star, "Hamburg", 1990).count() == 9
    assert rows(objects.number_name_place(star, "Artikel"))[0] == ("A01", "Mutter", "Hamburg")
    assert objects.number_name_place(star).columns == ["nummer", "namen", "orte"]
    assert objects.number_name_place(star, "unbekannt").count() == 0
    by_name, by_number = objects.deliveries_in_month(star, "Juli"), objects.deliveries_in_month(star, 7)
    assert rows(by_name) == rows(by_number) and by_name.count() == 3
    assert objects.deliveries_in_month(star, "13").count() == 0
    assert rows(objects.deliveries_in_month(star, "august"))[0][3] == "01.08.1990"
    assert values(objects.parts_by_colour(star, "Blau").select("anr")) == ["A03", "A05"]
    assert objects.parts_by_colour(star).count() == 6
    found = objects.parts_at_place_of(star, "A03").collect()
    assert [(r.anr, r.ort, r.farbe) for r in found] == [("A03", "Mannheim", "blau")]
    assert values(objects.chosen_columns(star.artikel, ["aname"], "amenge", 900)) == ["Bolzen", "Nockenwelle", "Schraube"]


def test_report(star, rows):
    assert rows(deliveries_per_supplier(star)) == [
        ("L01", "Schmidt", 6), ("L02", "Jonas", 2), ("L03", "Blank", 1), ("L04", "Clark", 3)]


def test_stock_follows_deliveries(star):
    def levels(parts):
        return {r.anr: r.amenge for r in parts.collect()}

    new = model.delivery_rows(star.spark, [("L03", "A06", 500, "2022-06-30")])
    received = stock.maintain_stock(star.artikel, inserted=new)
    assert levels(received)["A06"] == 1000
    corrected = new.withColumn("anr", F.lit("A05"))
    moved = stock.maintain_stock(received, inserted=corrected, deleted=new)
    assert (levels(moved)["A06"], levels(moved)["A05"]) == (500, 1800)
    assert levels(stock.maintain_stock(moved, deleted=corrected)) == levels(star.artikel)


def test_numbering(star, rows):
    numbered = numbering.number_rows(star.lieferant.select("lnr"), [F.col("lnr")], "nr")
    assert rows(numbered, "nr", "lnr") == [(1, "L01"), (2, "L02"), (3, "L03"), (4, "L04"), (5, "L05")]


def test_cascade(star, rows):
    renamed = star.spark.createDataFrame([("L04", "L06")], "old string, new string")
    assert rows(changes.cascade_key(star.lieferant, renamed, "lnr"), "lnr")[-1] == ("L06",)
    moved = changes.cascade_key(star.lieferung, renamed, "lnr")
    assert moved.filter("lnr = 'L06'").count() == 3 and moved.filter("lnr = 'L04'").count() == 0


def test_letter_case_can_be_ignored_everywhere(star, values):
    more = model.supplier_rows(star.spark, [("l06", "anders", 5, "HAMBURG  "), ("L07", "Zorn", 40, "aachen")])
    mixed = star.with_tables(lieferant=star.lieferant.union(more),
                             lieferung=star.lieferung.union(model.delivery_rows(star.spark, [("L06", "a01", 5, "1990-01-01")])))
    loose = model.case_insensitive(mixed)
    assert loose.lieferant.select("lstadt").distinct().count() == 3
    assert selections.all_places(loose).count() == 4 and selections.all_places(mixed).count() == 4
    assert ex.suppliers_of_every_part(loose).count() == 1
    assert len(values(ex.that_delivered(loose, loose.lieferung, "in").select("lnr"))) == 5
    assert loose.lieferant.filter(text.like("lname", "[a-b]%")).count() == 3
    assert objects.suppliers_at(loose, "hamburg").count() == 3
    assert loose.lieferung.agg(F.countDistinct("anr")).first()[0] == 6
    assert mixed.lieferant.agg(text.first_in_alphabet("lname")).first()[0] == "Adam"
    assert mixed.lieferant.filter("lnr != 'L05'").agg(text.first_in_alphabet("lname")).first()[0] == "anders"
