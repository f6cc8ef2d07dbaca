"""Constraints as checks that split a batch into accepted rows and rejects with their reasons."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.functions.text import comparable, like, text_in
from depotflow.session import frozen


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    """Constraints of one table: named checks, required columns, unique keys, foreign keys."""

    checks: dict[str, Column] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    keys: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: dict[str, ForeignKey] = field(default_factory=dict)


def broken_checks(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add ``verletzt``, the names of the row checks a row breaks, in one pass.

    A check is broken only where it is false: unknown passes.
    """
    found = [F.when(~check, F.lit(name)) for name, check in rules.checks.items()]
    found += [F.when(F.col(name).isNull(), F.lit(f"{name}_null")) for name in rules.required]
    # Without any rule there is nothing to compact.
    names = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return rows.withColumn("verletzt", names)


def _keys(rows: DataFrame, columns: tuple[str, ...], names: tuple[str, ...] | None = None) -> list[Column]:
    """Key columns as they are compared: letter case and trailing blanks of texts do not count."""
    return [comparable(rows, c).alias(n) for c, n in zip(columns, names or columns)]


def duplicate_keys(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once; NULL counts as one value.

    Of several spellings of one text the first is shown.
    """
    names = tuple(f"_{c}" for c in columns)
    shown = [F.min(c).alias(c) for c in columns]
    found = rows.groupBy(*_keys(rows, columns, names)).agg(*shown, F.count("*").alias("anzahl"))
    return found.filter("anzahl > 1").drop(*names)


def _known(columns: tuple[str, ...]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def _parents(key: ForeignKey, names: tuple[str, ...]) -> DataFrame:
    return key.parent.select(*_keys(key.parent, key.parent_columns, names)).distinct()


def orphans(rows: DataFrame, key: ForeignKey) -> DataFrame:
    """Rows whose key has no parent; a NULL in the key is not checked."""
    names = tuple(f"_{c}" for c in key.columns)
    keyed = rows.filter(_known(key.columns)).select("*", *_keys(rows, key.columns, names))
    return keyed.join(_parents(key, names), list(names), "left_anti").select(*rows.columns)


def judge(rows: DataFrame, rules: Rules, existing: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``verletzt``, the names of all rules a row breaks.

    Only ``rows`` are judged; ``existing`` rows count for unique keys and are taken as they are.
    All rows that share a key are rejected, as a set-based insert would reject them.

    The rows are read twice: once for their key columns, from which the offending key values of all
    rules are found and written as one table, and once to be judged.
    """
    columns = tuple(dict.fromkeys(c for own in [*rules.keys.values(), *(k.columns for k in rules.foreign_keys.values())]
                                  for c in own))
    judged = broken_checks(rows, rules)
    if not columns:
        return judged
    keys = frozen(rows.select(*_keys(rows, columns)))
    found = [(name, own, _taken(keys, own, existing)) for name, own in rules.keys.items()]
    found += [(name, key.columns, _orphan_keys(keys, key)) for name, key in rules.foreign_keys.items()]
    types = {f.name: f.dataType for f in keys.schema.fields}
    offending = None
    for name, own, wrong in found:
        shaped = wrong.select(F.lit(name).alias("_rule"), *[
            (F.col(c) if c in own else F.lit(None)).cast(types[c]).alias(c) for c in columns])
        offending = shaped if offending is None else offending.unionByName(shaped)
    offending = frozen(offending)
    for name, own, _wrong in found:
        judged = _mark(judged, name, own, offending.filter(F.col("_rule") == name))
    return judged


def parted(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judged rows as accepted ones, and rejected ones with ``verletzt``."""
    accepted = judged.filter(F.size("verletzt") == 0).drop("verletzt")
    return accepted, judged.filter(F.size("verletzt") > 0)


def validate(rows: DataFrame, rules: Rules, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with ``verletzt``."""
    return parted(judge(rows, rules, existing))


def _taken(keys: DataFrame, columns: tuple[str, ...], existing: DataFrame | None) -> DataFrame:
    """Key values that occur more than once in ``keys`` or that ``existing`` rows have already."""
    counts = keys.groupBy(*columns).agg(F.count("*").alias("_rows"))
    again = counts.filter("_rows > 1").select(*columns)
    if existing is None:
        return again
    names = tuple(f"_{c}" for c in columns)
    same = F.lit(True)
    for c, n in zip(columns, names):
        same = same & F.col(c).eqNullSafe(F.col(n))
    old = existing.select(*_keys(existing, columns, names)).join(counts.select(*columns), same, "left_semi")
    return again.unionByName(old.toDF(*columns)).distinct()


def _orphan_keys(keys: DataFrame, key: ForeignKey) -> DataFrame:
    """Known key values that the parent does not have."""
    own = keys.select(*key.columns).filter(_known(key.columns)).distinct()
    return own.join(_parents(key, key.columns), list(key.columns), "left_anti")


def _mark(judged: DataFrame, name: str, columns: tuple[str, ...], offending: DataFrame) -> DataFrame:
    """Add the rule's name to the rows with an offending key, NULL being equal to NULL."""
    wrong = offending.select(*[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit"))
    same = F.lit(True)
    for c in columns:
        same = same & comparable(judged, c).eqNullSafe(F.col(f"_{c}"))
    marked = judged.join(wrong, same, "left")
    told = F.when(F.col("_hit"), F.array_append("verletzt", F.lit(name))).otherwise(F.col("verletzt"))
    return marked.withColumn("verletzt", told).select(*judged.columns)


# --- the rules of the model -------------------------------------------------------------------
# Bounds, patterns and names of these rules are fixed values.


def _code_number(column: str, length: int) -> Column:
    """Digits after the first letter; NULL where there are none."""
    return F.substring(column, 2, length).try_cast("int")


def _code(column: str, letter: str, length: int, high: int) -> Column:
    """A letter and a number from 1 to ``high``; text in place of the number breaks the rule."""
    number = F.coalesce(_code_number(column, length).between(1, high), F.lit(False))
    return F.when(F.col(column).isNotNull(), like(column, f"{letter}%") & number)


def supplier_rules() -> Rules:
    return Rules(
        checks={
            "lnr_chk": _code("lnr", "l", 2, 99),
            "lname_chk": like("lname", "[A-Z]%"),
            "status_chk": F.col("status").between(1, 99),
            "lstadt_chk": like("lstadt", "[A-Z]%"),
        },
        required=("lnr", "lname"),
        keys={"lnr_ps": ("lnr",)},
    )


def part_rules() -> Rules:
    return Rules(
        checks={
            "anr_chk": _code("anr", "a", 2, 99),
            "farbe_chk": text_in("farbe", "rot", "blau", "grün", "schwarz", "gelb"),
            "amenge_chk": F.col("amenge").between(0, 10000),
        },
        required=("anr", "aname"),
        keys={"anr_ps": ("anr",)},
    )


def delivery_rules(suppliers: DataFrame, parts: DataFrame) -> Rules:
    return Rules(
        checks={"lmenge_chk": F.col("lmenge").between(1, 1000000)},
        required=("lnr", "anr", "lmenge", "ldatum"),
        keys={"lief_ps": ("lnr", "anr", "ldatum")},
        foreign_keys={
            "lnr_fs": ForeignKey(("lnr",), suppliers, ("lnr",)),
            "anr_fs": ForeignKey(("anr",), parts, ("anr",)),
        },
    )


def full_name_check(name: str, first_name: str) -> Column:
    """A first name must not stand without a name."""
    return F.col(name).isNotNull() | F.col(first_name).isNull()


def research_rules(tables: dict[str, DataFrame], today: date) -> dict[str, Rules]:
    """Constraints of the research tables orte, abteilung, projekt, mitarbeiter, arbeiten, telefon."""
    def parent(columns: tuple[str, ...], table: str) -> ForeignKey:
        return ForeignKey(columns, tables[table], columns)

    return {
        "orte": Rules(required=("ortid",), keys={"ortid_ps": ("ortid",), "orte_unq": ("plz", "ortsname")}),
        "abteilung": Rules(
            checks={
                "abt_nr_chk": (like("abt_nr", "a[1-9]") | like("abt_nr", "a[1-9][0-9]"))
                & F.coalesce(_code_number("abt_nr", 2).between(1, 50), F.lit(False)),
                "abt_name_chk": like("abt_name", "[A-Z]%"),
                "aortid_chk": F.col("ortid").between(1, 7),
            },
            required=("abt_nr", "abt_name", "ortid"),
            keys={"abt_nr_ps": ("abt_nr",)},
            foreign_keys={"aortid_fs": parent(("ortid",), "orte")},
        ),
        "projekt": Rules(
            checks={
                "pr_nr_chk": (
                    like("pr_nr", "p[1-9]") | like("pr_nr", "p[1-9][0-9]") | like("pr_nr", "p[1-9][0-9][0-9]")
                ) & F.coalesce(_code_number("pr_nr", 3).between(1, 150), F.lit(False)),
                "pr_name_chk": like("pr_name", "[A-Z]%"),
                "mittel_chk": F.col("mittel").between(1, 2000000),
            },
            required=("pr_nr", "pr_name", "mittel"),
            keys={"pr_nr_ps": ("pr_nr",)},
        ),
        "mitarbeiter": Rules(
            checks={
                "m_name_chk": like("m_name", "[A-Z]%"),
                "m_vorname_chk": like("m_vorname", "[A-Z]%"),
                "strasse_chk": like("strasse", "[A-Z]%"),
            },
            required=("m_nr", "m_name", "ortid"),
            keys={"m_nr_ps": ("m_nr",)},
            foreign_keys={
                "mortid_fs": parent(("ortid",), "orte"),
                "abt_nr_fs": parent(("abt_nr",), "abteilung"),
            },
        ),
        "arbeiten": Rules(
            checks={
                "aufgabe_chk": like("aufgabe", "[A-Z]%"),
                "einst_dat_chk": F.col("einst_dat") >= F.lit(today - timedelta(days=7)),
            },
            required=("m_nr", "pr_nr", "einst_dat"),
            keys={"arbeiten_ps": ("m_nr", "pr_nr")},
            foreign_keys={
                "m_nr_fs": parent(("m_nr",), "mitarbeiter"),
                "pr_nr_fs": parent(("pr_nr",), "projekt"),
            },
        ),
        "telefon": Rules(
            required=("m_nr", "vorw", "tel_nr"),
            keys={"tel_ps": ("vorw", "tel_nr")},
            foreign_keys={"m_nr_fk": parent(("m_nr",), "mitarbeiter")},
        ),
    }
