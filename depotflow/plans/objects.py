"""Views, table functions and parameterised queries of the model.

The names in ``OBJECTS`` are fixed values: callers know the objects by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions import dates, text
from depotflow.sources.star import Star


def suppliers_at(star: Star, place: str = "Hamburg") -> DataFrame:
    """View on number, name and place of the suppliers at one place."""
    return star.lieferant.filter(at_place(place)).select("lnr", "lname", "lstadt")


def at_place(place: str) -> Column:
    return text.same_text("lstadt", place)


def deliveries_with_supplier(star: Star) -> DataFrame:
    """View on every delivery with its supplier."""
    return star.lieferung.join(star.lieferant, "lnr").select(
        "lnr", "lname", "status", "lstadt", "anr", "lmenge", "ldatum"
    )


def deliveries_of(star: Star, place: str = "Hamburg", year: int = 1990) -> DataFrame:
    """What the suppliers of a place delivered in a year."""
    return (
        star.lieferung.filter(dates.in_year("ldatum", year))
        .join(star.lieferant.filter(at_place(place)), "lnr")
        .join(star.artikel, "anr")
        .select("lnr", "lname", "lstadt", "ldatum", "aname")
    )


def number_name_place(star: Star, table: str = "lieferant") -> DataFrame:
    """Suppliers or parts as number, name and place; no rows for another table name."""
    columns = {"lieferant": ("lnr", "lname", "lstadt"), "artikel": ("anr", "aname", "astadt")}
    name = table.strip().lower()
    number, called, place = columns.get(name, columns["lieferant"])
    rows = star.artikel if name == "artikel" else star.lieferant
    result = rows.select(F.col(number).alias("nummer"), F.col(called).alias("namen"), F.col(place).alias("orte"))
    return result if name in columns else result.limit(0)


def deliveries_in_month(star: Star, month: str | int) -> DataFrame:
    """Deliveries of a month, given as 1 to 12 or by its German name, in any year."""
    number = dates.month_number(str(month))
    chosen = F.lit(False) if number is None else F.month("ldatum") == number
    return (
        star.lieferung.filter(chosen)
        .join(star.lieferant, "lnr")
        .join(star.artikel, "anr")
        .select(
            F.col("lnr").alias("lieferantennummer"),
            F.col("lname").alias("lieferantenname"),
            F.col("aname").alias("artikelname"),
            dates.german_text("ldatum").alias("lieferdatum"),
        )
    )


def parts_by_colour(star: Star, colour: str | None = None) -> DataFrame:
    """Parts of one colour, or all parts."""
    rows = star.artikel if colour is None else star.artikel.filter(text.same_text("farbe", colour))
    return rows.select("anr", "aname", "astadt")


def chosen_columns(df: DataFrame, columns: list[str], where: str, at_least) -> DataFrame:
    """Columns and condition column chosen at run time; the value stays a value."""
    return df.filter(F.col(where) >= F.lit(at_least)).select(*columns)


def parts_at_place_of(star: Star, number) -> DataFrame:
    """Look one part up and list what is stored at its place, with that part's colour beside it."""
    found = star.artikel.filter(F.col("anr") == F.lit(number))
    same = text.comparable(star.artikel, "astadt")
    place = found.select(same).scalar()
    colour = found.select("farbe").scalar()
    return star.artikel.filter(same == place).select(
        "anr", "aname", "amenge", F.col("astadt").alias("ort"), colour.alias("farbe")
    )


OBJECTS = {
    "hamb_lief": suppliers_at,
    "lieflief": deliveries_with_supplier,
    "v_lieflief": deliveries_with_supplier,
    "v_lftart": deliveries_of,
    "fk_lftart": deliveries_of,
    "fk_lieferartikel": number_name_place,
    "fk_liefmonat": deliveries_in_month,
    "farb_art": parts_by_colour,
    "isowoche": dates.iso_week,
    "fk_datsep": dates.day_month_year,
    "fk_plzvalid": text.valid_postcode,
}
