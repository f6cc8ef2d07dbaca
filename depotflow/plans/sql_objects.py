"""The model's views and functions under their names in SQL, and parameterised statements.

``register`` makes the three tables, the views and the functions known to a session. Bodies are SQL, so the optimizer
sees through a call: a filter on a function's result reaches the scan, and columns nobody asks for are not read.
Everything is temporary: it ends with the session and is replaced by the next call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from depotflow.functions.dates import MONTHS
from depotflow.plans import objects
from depotflow.plans.jobs import MONTH, of_city
from depotflow.plans.registry import query
from depotflow.sources.star import Star


def _same(left: str, right: str) -> str:
    """Equality of texts that ignores letter case and trailing blanks, as in the DataFrame form."""
    return f"lower(rtrim({left})) = lower(rtrim({right}))"


VIEWS = {name: objects.OBJECTS[name] for name in ("hamb_lief", "lieflief", "v_lieflief", "v_lftart")}

#: Number of a month that is given as 1 to 12 or by its German name; 0 for anything else.
MONTH_OF = f"""
    CASE WHEN trim(monat) RLIKE '^[0-9]+$' THEN coalesce(try_cast(trim(monat) AS INT), 0)
         ELSE array_position(array({", ".join(f"'{name.lower()}'" for name in MONTHS)}), lower(trim(monat))) END"""

#: Head and body of every function. A table function's columns follow from its body.
FUNCTIONS = {
    "fk_lftart(ort STRING DEFAULT 'Hamburg', jahr INT DEFAULT 1990) RETURNS TABLE": f"""
        SELECT lnr, lname, lstadt, ldatum, aname
        FROM lieferung JOIN lieferant USING (lnr) JOIN artikel USING (anr)
        WHERE {_same("lstadt", "fk_lftart.ort")}
          AND ldatum >= make_date(fk_lftart.jahr, 1, 1) AND ldatum < make_date(fk_lftart.jahr + 1, 1, 1)""",
    "fk_lieferartikel(tabname STRING DEFAULT 'lieferant') RETURNS TABLE": """
        SELECT lnr AS nummer, lname AS namen, lstadt AS orte FROM lieferant WHERE lower(trim(tabname)) = 'lieferant'
        UNION ALL SELECT anr, aname, astadt FROM artikel WHERE lower(trim(tabname)) = 'artikel'""",
    "fk_liefmonat(monat STRING) RETURNS TABLE": f"""
        SELECT lnr AS lieferantennummer, lname AS lieferantenname, aname AS artikelname,
               date_format(ldatum, 'dd.MM.yyyy') AS lieferdatum
        FROM lieferung JOIN lieferant USING (lnr) JOIN artikel USING (anr) WHERE month(ldatum) = {MONTH_OF}""",
    "farb_art(wunsch STRING DEFAULT NULL) RETURNS TABLE": f"""
        SELECT anr, aname, astadt FROM artikel WHERE wunsch IS NULL OR {_same("farbe", "wunsch")}""",
    "isowoche(tag TIMESTAMP) RETURNS INT": "weekofyear(tag)",
    "fk_datsep(tag TIMESTAMP, zeichen STRING) RETURNS STRING": "concat_ws(zeichen, day(tag), month(tag), year(tag))",
    "fk_plzvalid(plz STRING) RETURNS BOOLEAN": r"coalesce(plz RLIKE '^[0-9]{5}\\z', false)",
}


def register(star: Star) -> None:
    """Make the tables, views and functions of ``star`` known to its session."""
    for name in ("lieferant", "artikel", "lieferung"):
        getattr(star, name).createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
    for head, body in FUNCTIONS.items():
        star.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def asked(star: Star, statement: str, **values) -> DataFrame:
    """Result of one statement on the registered objects; ``values`` stay values."""
    register(star)
    return star.spark.sql(statement, args=values or None)


@query("q2_view_in_sql", """
    SELECT lstadt, count(*) AS lieferungen, sum(lmenge)::BIGINT AS menge FROM lieferung JOIN lieferant USING (lnr)
    GROUP BY lstadt""")
def _(star):
    return asked(star, "SELECT lstadt, count(*) AS lieferungen, sum(lmenge) AS menge FROM v_lieflief GROUP BY lstadt")


@query("q4_called_in_sql", of_city(11, 2000))
def _(star):
    return asked(star, "SELECT * FROM fk_lftart(ort => :ort, jahr => 2000)", ort="nation_11")


@query("q5_called_in_sql", "SELECT anr AS nummer, aname AS namen, astadt AS orte FROM artikel WHERE contains(aname, 'e')")
def _(star):
    return asked(star, "SELECT * FROM fk_lieferartikel('Artikel') WHERE namen LIKE '%e%'")


@query("q5_default_in_sql", "SELECT lnr AS nummer, lname AS namen, lstadt AS orte FROM lieferant")
def _(star):
    return asked(star, "SELECT * FROM fk_lieferartikel()")


@query("q6_called_in_sql", f"{MONTH} 7")
def _(star):
    return asked(star, "SELECT * FROM fk_liefmonat(:monat)", monat="juli ")


@query("q7_called_in_sql", """
    SELECT lnr, anr, ldatum, week(ldatum)::INTEGER AS woche, concat(day(ldatum), '#', month(ldatum), '#', year(ldatum)) AS datum,
           lnr * 1000 + anr BETWEEN 10000 AND 99999 AS gueltig FROM lieferung""")
def _(star):
    return asked(star, """
        SELECT lnr, anr, ldatum, isowoche(ldatum) AS woche, fk_datsep(ldatum, '#') AS datum,
               fk_plzvalid(CAST(lnr * 1000 + anr AS STRING)) AS gueltig FROM lieferung""")


@query("q8_called_in_sql", "SELECT anr, aname, astadt FROM artikel WHERE aname LIKE 'red %'")
def _(star):
    return asked(star, "SELECT * FROM farb_art(wunsch => 'RED')")


@query("f19_executed_statement", "SELECT aname, astadt FROM artikel WHERE amenge >= 950")
def _(star):
    register(star)
    return star.spark.sql("""
        EXECUTE IMMEDIATE 'SELECT aname, astadt FROM IDENTIFIER(:tab) WHERE IDENTIFIER(:spalte) >= :grenze'
        USING 'artikel' AS tab, 'amenge' AS spalte, 950 AS grenze""")
