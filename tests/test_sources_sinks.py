"""Sources, sinks and the stock feed."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from depotflow.functions import dates
from depotflow.operators import stock, validation
from depotflow.session import frozen, shared_folder
from depotflow.sources import readers, sinks, star as model
from depotflow.streaming import stock_feed


def test_generated_rows(spark):
    made = readers.generate(spark, 5000)
    assert made.count() == 5000 and made.rdd.getNumPartitions() > 1
    assert tuple(made.filter("id = 42").first()) == (42, "42Lagerkraft", "Nr_42", "42_Halle_42")
    assert made.filter("vname like '%3099%'").count() == 1
    assert made.filter(F.col("id").between(3055, 10344)).count() == 1946


def test_query_without_table(spark):
    row = readers.one_row(spark, product=F.lit(5) * 20, now=F.current_timestamp()).first()
    assert row["product"] == 100 and row["now"] is not None


def test_binary_files(spark, tmp_path):
    (tmp_path / "bild.jpg").write_bytes(b"\x00\xff\x10")
    (tmp_path / "text.txt").write_text("x")
    found = readers.binary_files(spark, str(tmp_path), "*.jpg").collect()
    assert [(r.typ, r.bytes, bytes(r.bild)) for r in found] == [(".jpg", 3, b"\x00\xff\x10")]


def test_stored_model(star, tmp_path, rows):
    model.store(star, str(tmp_path / "m"))
    again = model.load(star.spark, str(tmp_path / "m"))
    for name in ("lieferant", "artikel", "lieferung"):
        assert rows(getattr(again, name)) == rows(getattr(star, name))
    month = again.lieferung.filter(dates.in_month("ldatum", 1990, 8)).select("anr")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ldatum" in plan and "LessThan(ldatum" in plan
    assert "ReadSchema: struct<anr:string,ldatum:timestamp_ntz>" in plan


def test_tables(star, rows):
    spark = star.spark
    saved = sinks.into_table(star.lieferant, "lief_kopie")
    assert rows(saved) == rows(star.lieferant)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.into_table(star.lieferant, "lief_kopie")
    sinks.append_to_table(star.lieferant, "lief_kopie")
    assert spark.table("lief_kopie").count() == 10
    assert model.qualified(spark, "server.spark_catalog.default.lief_kopie").count() == 10
    assert model.qualified(spark, "default.lief_kopie").count() == 10


def test_views_are_snapshots(star, tmp_path):
    spark = star.spark
    path = str(tmp_path / "t")
    star.lieferant.write.parquet(path)
    sinks.into_session_view(spark.read.parquet(path), "schnappschuss")
    sinks.into_shared_view(spark.read.parquet(path), "schnappschuss")
    star.lieferant.write.mode("append").parquet(path)
    assert spark.table("schnappschuss").count() == 5
    assert spark.newSession().table("global_temp.schnappschuss").count() == 5
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.newSession().table("schnappschuss")


def test_folders(star, tmp_path):
    path = str(tmp_path / "hist")
    assert sinks.into_folder(star.lieferung, path).count() == 12
    assert sinks.append_to_folder(star.lieferung, path).count() == 24
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.into_folder(star.lieferung, path)


def test_publish_all_or_nothing(star, tmp_path):
    moved = star.lieferant.withColumn("lstadt", F.lit("Erfurt"))
    assert sinks.publish_if(moved, str(tmp_path / "a"), lambda r: r["status"] / 1 > 25) is None
    assert sinks.publish_if(moved, str(tmp_path / "b"), lambda r: r["status"] > 100).count() == 5


def test_reports(star, tmp_path):
    spark = star.spark
    sinks.write_xml_report(star.lieferant.filter("lnr = 'L05'"), str(tmp_path / "xml"), "a")
    text = [r.value for r in spark.read.text(str(tmp_path / "xml")).collect()]
    assert text == ["<a><lnr>L05</lnr><lname>Adam</lname><status>30</status><lstadt>Aachen</lstadt></a>"]
    escaped = spark.createDataFrame([("a<b&c", None)], "x string, y string")
    assert escaped.select(sinks.xml_elements("r", "x", "y")).first()[0] == "<r><x>a&lt;b&amp;c</x></r>"
    sinks.write_csv_report(star.lieferant, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 5


def test_frozen_rows_stay(spark):
    drawn = frozen(spark.range(100).select(F.rand().alias("r")))
    assert drawn.collect() == drawn.collect()


def test_cluster_needs_a_shared_folder():
    class Cluster:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Cluster()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def changes_of(spark, *rows):
    return spark.createDataFrame(list(rows), "was string, anr string, lmenge int")


def levels(parts):
    return {r.anr: r.amenge for r in parts.collect()}


def test_feed_in_several_batches(star, tmp_path):
    spark = star.spark
    source = tmp_path / "in"
    batches = [
        changes_of(spark, ("Insert", "A06", 500), ("Insert", "A06", 20), ("Delete", "A01", 300)),
        changes_of(spark, ("Delete", "A06", 500), ("Insert", "A05", 500)),
        changes_of(spark, ("Insert", "A99", 1)),
    ]
    folder = shared_folder(spark, "feed")
    for number, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(str(source / f"b{number}"))
        feed = spark.readStream.schema(batch.schema).parquet(str(source / "*"))
        stock_feed.start(feed, folder, f"{folder}/fortschritt").awaitTermination()
    expected = {**levels(star.artikel), "A06": 520, "A01": 500, "A05": 1800}
    assert levels(stock_feed.current_stock(spark, star.artikel, folder)) == expected


def test_replayed_batch_counts_once(star):
    spark = star.spark
    folder = shared_folder(spark, "feed")
    batch = changes_of(spark, ("Insert", "A06", 500), ("Insert", "A06", 1))
    for _ in range(3):
        stock_feed.write_batch(batch, 0, folder)
    stock_feed.write_batch(changes_of(spark, ("Delete", "A06", 1)), 1, folder)
    assert levels(stock_feed.current_stock(spark, star.artikel, folder))["A06"] == 1000


def test_feed_with_check(star, tmp_path):
    spark = star.spark
    batch = changes_of(spark, ("Insert", "A06", 500), ("Insert", "A99", 1), ("Insert", "A06", 0))
    batch.coalesce(1).write.parquet(str(tmp_path / "in"))
    key = validation.ForeignKey(("anr",), star.artikel, ("anr",))
    rules = validation.Rules(checks={"lmenge_chk": F.col("lmenge") >= 1}, foreign_keys={"anr_fs": key})
    folder = shared_folder(spark, "feed")
    feed = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    check = lambda rows: validation.validate(rows, rules)
    stock_feed.start(feed, folder, f"{folder}/fortschritt", check).awaitTermination()
    assert levels(stock_feed.current_stock(spark, star.artikel, folder))["A06"] == 1000
    refused = spark.read.parquet(f"{folder}/failed/batch=0").collect()
    assert sorted((r.anr, r.verletzt) for r in refused) == [("A06", ["lmenge_chk"]), ("A99", ["anr_fs"])]


def test_a_published_batch_is_left_alone(star):
    """A replay while a reader is at work takes nothing away from it, and rejects are found."""
    spark = star.spark
    folder = shared_folder(spark, "feed")
    assert levels(stock_feed.current_stock(spark, star.artikel, folder)) == levels(star.artikel)
    assert stock_feed.rejects(spark, folder) is None
    batch = changes_of(spark, ("Insert", "A06", 500), ("insert", "A06", 7), ("Insert", None, 1), ("Delete", "A05", None))
    stock_feed.write_batch(batch, 0, folder)
    reader = stock_feed.current_stock(spark, star.artikel, folder)
    stock_feed.write_batch(batch, 0, folder)
    assert levels(reader)["A06"] == 1000
    assert sorted(r.grund for r in stock_feed.rejects(spark, folder).collect()) == ["anr", "lmenge", "was"]


def test_unfinished_batch_is_not_seen(star):
    spark = star.spark
    folder = shared_folder(spark, "feed")
    stock_feed.write_batch(changes_of(spark, ("Insert", "A06", 500)), 0, folder)
    stock.stock_delta(star.lieferung).write.parquet(f"{folder}/deltas/batch=1")
    assert levels(stock_feed.current_stock(spark, star.artikel, folder))["A06"] == 1000


def test_compaction_keeps_the_stock(star):
    spark = star.spark
    folder = shared_folder(spark, "feed")
    for number in range(3):
        stock_feed.write_batch(changes_of(spark, ("Insert", "A06", 10 ** number)), number, folder)
    stock_feed.compact(spark, folder)
    stock_feed.compact(spark, folder)
    assert levels(stock_feed.current_stock(spark, star.artikel, folder))["A06"] == 611
    # A batch that is replayed after it was folded in stays folded in.
    stock_feed.write_batch(changes_of(spark, ("Insert", "A06", 100)), 2, folder)
    stock_feed.write_batch(changes_of(spark, ("Insert", "A06", 1000)), 3, folder)
    assert levels(stock_feed.current_stock(spark, star.artikel, folder))["A06"] == 1611
    stock_feed.compact(spark, folder)
    assert levels(stock_feed.current_stock(spark, star.artikel, folder))["A06"] == 1611
    root = Path(folder.removeprefix("file:"))
    assert [p.name for p in (root / "deltas").glob("batch=*")] == ["batch=3"]
    assert sorted(p.name for p in (root / "published" / "deltas").iterdir() if not p.name.startswith(".")) == ["batch=3"]
