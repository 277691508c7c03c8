"""Ranks and running totals over a whole table without a single-task window.

Rows are range-partitioned on the full ordering key.  Because the key ends in a unique id, one
score shared by a third of all customers is still cut into many slots.  Slot totals (one row per
slot) give every slot its starting offset; the remaining window runs inside a slot only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.stability import materialise, partition_count

SLOT = "_slot"


@dataclass(frozen=True)
class Placement:
    """Range-placed rows plus, per group and slot, what lies before the slot and inside it."""

    rows: DataFrame
    slots: DataFrame
    by: tuple[str, ...]
    order: tuple[Column, ...]
    sums: tuple[str, ...]


def place(df: DataFrame, order, sums=(), by=(), slots: int | None = None) -> Placement:
    """Cut ``df`` into ordered slots, materialised once so slot borders cannot move between uses."""
    count = slots or partition_count(df.sparkSession)
    rows = materialise(
        df.repartitionByRange(count, *[F.col(name) for name in by], *order)
        .withColumn(SLOT, F.spark_partition_id())
    )
    inside = rows.groupBy(*by, SLOT).agg(
        F.count(F.lit(1)).alias("_in_rows"), *[F.sum(name).alias(f"_in_{name}") for name in sums]
    )
    # One row per (group, slot): at most slots + groups rows, however large the table is.
    earlier = Window.partitionBy(*by).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    measures = ("rows", *sums)
    slot_table = materialise(inside.select(
        *by, SLOT,
        *[F.col(f"_in_{name}") for name in measures],
        *[F.coalesce(F.sum(f"_in_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in measures],
    ))
    return Placement(rows, slot_table, tuple(by), tuple(order), tuple(sums))


def whole(placement: Placement) -> Column:
    """Size and totals of an ungrouped placement as one struct (``n`` and a field per sum).

    Read from the slot table, so no second pass over the ranked rows is needed.
    """
    return placement.slots.agg(F.struct(
        F.coalesce(F.sum("_in_rows"), F.lit(0)).cast("bigint").alias("n"),
        *[F.sum(f"_in_{name}").alias(name) for name in placement.sums],
    )).scalar()


def unfold(placement: Placement, slots: DataFrame | None = None, carry=()) -> DataFrame:
    """Add ``rank`` and ``cum_<name>`` within each group.

    ``slots`` may keep only some slots; ``carry`` names columns of it to hand on to the rows.
    """
    by, sums = placement.by, placement.sums
    offsets = (placement.slots if slots is None else slots).select(
        *by, SLOT, "_before_rows", *[f"_before_{name}" for name in sums], *carry
    )
    inside = Window.partitionBy(*by, SLOT).orderBy(*placement.order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    extra = [name for name in placement.rows.columns if name != SLOT]
    return placement.rows.join(offsets, [*by, SLOT]).select(
        *extra, *carry,
        (F.row_number().over(inside) + F.col("_before_rows")).cast("bigint").alias("rank"),
        *[(F.sum(name).over(running) + F.col(f"_before_{name}")).alias(f"cum_{name}") for name in sums],
    )


def running_totals(df: DataFrame, order, sums=(), by=(), slots: int | None = None) -> DataFrame:
    """``df`` plus ``rank`` (1..n within ``by``) and running sums, in ``order``."""
    return unfold(place(df, order, sums, by, slots))


def by_score(score: str, key: str = "customer_id") -> list[Column]:
    """Best score first, ties by key, so the order is total."""
    return [F.col(score).desc(), F.col(key).asc()]
