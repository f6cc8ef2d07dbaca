"""A batch of new deliveries from its check to the next version of every table it touches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from depotflow.operators import audit, changes, stock, validation
from depotflow.session import frozen


@dataclass(frozen=True)
class Receipt:
    """Rows taken and refused, the new tables, what the change did to the stock, and parts that forbid it.

    If a part would break the stock rule, nothing is published: the tables are the old ones and the log is empty.
    """

    accepted: DataFrame
    rejected: DataFrame
    deliveries: DataFrame
    parts: DataFrame
    log: DataFrame
    broken: DataFrame
    published: bool


def receive(
    suppliers: DataFrame,
    parts: DataFrame,
    deliveries: DataFrame,
    batch: DataFrame,
    number: int,
    when: datetime,
    who: Column | None = None,
    rules: validation.Rules | None = None,
    highest: int = stock.HIGHEST,
) -> Receipt:
    """Check the batch, add what it accepts to the deliveries and the stock, and log the new levels."""
    rules = rules or validation.delivery_rules(suppliers, parts)
    # The batch is read once; all results follow from one and the same set of accepted rows.
    judged = frozen(validation.judge(frozen(batch), rules, existing=deliveries))
    accepted, rejected = validation.parted(judged)
    delta = frozen(stock.stock_delta(inserted=accepted))
    stocked, broken = stock.checked_stock(parts, delta, high=highest)
    published = not broken.limit(1).count()
    if not published:
        delta, deliveries_after = delta.filter(F.lit(False)), deliveries
    else:
        deliveries_after = changes.insert(deliveries, accepted)
    # Every part of the batch is touched, whatever its new level.
    touched = parts.withColumn("amenge", F.col("amenge").cast("long")).join(delta, "anr")
    log = audit.updated(touched, F.lit(True), "anr", amenge=F.col("amenge") + F.col("menge"))
    return Receipt(
        accepted, rejected, deliveries_after, stocked, audit.stamped(log, number=number, when=when, who=who), broken,
        published,
    )
