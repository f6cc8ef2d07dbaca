"""Schemas of the supplier / part / delivery model and of the research model."""

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable)


LIEFERANT = T.StructType([
    _field("lnr", T.StringType(), False),
    _field("lname", T.StringType(), False),
    _field("status", T.IntegerType()),
    _field("lstadt", T.StringType()),
])

ARTIKEL = T.StructType([
    _field("anr", T.StringType(), False),
    _field("aname", T.StringType(), False),
    _field("farbe", T.StringType()),
    _field("gewicht", T.DecimalType(9, 2)),
    _field("astadt", T.StringType()),
    _field("amenge", T.LongType()),
])

LIEFERUNG = T.StructType([
    _field("lnr", T.StringType(), False),
    _field("anr", T.StringType(), False),
    _field("lmenge", T.IntegerType(), False),
    _field("ldatum", T.TimestampNTZType(), False),
])

SPION = T.StructType([
    _field("lfdnr", T.IntegerType()),
    _field("wann", T.TimestampNTZType()),
    _field("wer", T.StringType()),
    _field("was", T.StringType()),
    _field("primaerschluessel", T.StringType()),
    _field("neuer_wert", T.StringType()),
    _field("alter_wert", T.StringType()),
])

# Research model, used for constraint checks.
ORTE = T.StructType([
    _field("ortid", T.IntegerType(), False),
    _field("plz", T.StringType()),
    _field("ortsname", T.StringType()),
])

ABTEILUNG = T.StructType([
    _field("abt_nr", T.StringType(), False),
    _field("abt_name", T.StringType(), False),
    _field("ortid", T.IntegerType(), False),
])

PROJEKT = T.StructType([
    _field("pr_nr", T.StringType(), False),
    _field("pr_name", T.StringType(), False),
    _field("mittel", T.DecimalType(19, 4), False),
])

MITARBEITER = T.StructType([
    _field("m_nr", T.LongType(), False),
    _field("m_name", T.StringType(), False),
    _field("m_vorname", T.StringType()),
    _field("ortid", T.IntegerType(), False),
    _field("strasse", T.StringType()),
    _field("geb_dat", T.DateType()),
    _field("abt_nr", T.StringType()),
])

ARBEITEN = T.StructType([
    _field("m_nr", T.LongType(), False),
    _field("pr_nr", T.StringType(), False),
    _field("aufgabe", T.StringType()),
    _field("einst_dat", T.DateType(), False),
])

TELEFON = T.StructType([
    _field("m_nr", T.LongType(), False),
    _field("vorw", T.StringType(), False),
    _field("tel_nr", T.StringType(), False),
])

# Tables as they are stored; the model is mapped from some of them.
STORED = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
