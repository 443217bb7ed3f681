"""Consecutive numbers and predecessor lookups in a global order, without one task seeing all rows.

Rows are dealt to ranges of the order, which the engine chooses from a sample of them: their number
grows with the data, they hold about equal shares however values are spaced, and rows that agree in
the first column of the order are told apart by the next ones. The dealt rows are stored, as another
run of the same plan may choose other ranges. Only one row per range meets in a single window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.session import CODEC, stored

_ROW_BITS = 33  # of a monotonically increasing id: the row within its task


def in_ranges(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Store the rows by ranges of the order: `_range` rises with it, `_place` is 1, 2, ... within."""
    dealt = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id()
    return stored(
        dealt.select(
            "*",
            F.shiftright(place, _ROW_BITS).alias("_range"),
            (place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1).alias("_place"),
        ),
        "ranges",
        CODEC,
    )


def number_rows(
    df: DataFrame,
    name: str,
    order_by: Sequence[str | Column],
    within: Sequence[str] = (),
    start: Column | int = 0,
) -> DataFrame:
    """Add `name` = start + 1, start + 2, ... in `order_by` order (restarting in each `within` group)."""
    rows = in_ranges(df, [*within, *order_by])
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A range holds one stretch of each group it has rows of.
    offsets = rows.groupBy(*within, "_range").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    ).select(
        *within,
        "_range",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
    )
    if not within:
        offsets = F.broadcast(offsets)  # a row per range: spark.sql.shuffle.partitions at most
    base = start if isinstance(start, Column) else F.lit(start)
    return (
        rows.join(offsets, [*within, "_range"])
        .withColumn(name, (F.col("_offset") + F.col("_place") + base).cast("bigint"))
        .drop("_range", "_place", "_offset")
    )


def previous_value(
    df: DataFrame, name: str, key: str, order_by: str, value: str
) -> DataFrame:
    """Add `name` = the last non-NULL `value` among the rows before, in `order_by` order within `key`.

    A key may hold any share of the rows: it is cut at the ends of ranges, and each part starts from
    the last value of the parts before it.
    """
    rows = in_ranges(df, [key, order_by]).drop("_place")

    def last_before(column: str, window) -> Column:
        return F.last(column, ignorenulls=True).over(
            window.rowsBetween(Window.unboundedPreceding, -1)
        )

    # Rows without a value have no place in the order, so max_by passes them over; a part that has
    # only such rows still gets its row.
    place = F.when(F.col(value).isNotNull(), F.col(order_by))
    carried = (
        rows.groupBy(key, "_range")
        .agg(F.max_by(value, place).alias("_last"))
        .select(
            key,
            "_range",
            last_before("_last", Window.partitionBy(key).orderBy("_range")).alias("_carried"),
        )
    )
    inside = last_before(value, Window.partitionBy(key, "_range").orderBy(order_by))
    return (
        rows.withColumn("_inside", inside)
        .join(carried, [key, "_range"], "left")
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop("_range", "_inside", "_carried")
    )


def max_key(df: DataFrame, column: str) -> Column:
    """Largest value of a key column, 0 for an empty table, usable inside another query."""
    return df.agg(F.coalesce(F.max(column), F.lit(0))).scalar()
