"""Ordered computations over groups of any size.

A window partitioned by a key sends the whole group to one task, so a key with a third of the rows
stalls the job. Here rows are range-partitioned on (group, order) instead, which cuts a large group
into even slices, and each slice is finished with what the earlier slices of its group carry over.
The carry table has at most one row per slice boundary, which is why it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.session import by_range, materialize

AT, SLICE = "_at", "_slice"


def range_sliced(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with a slice number and a position that follows (by, order). ``order`` must be total."""
    keys = [F.col(c) for c in by] + list(order)
    laid = by_range(df, keys).withColumn(AT, F.monotonically_increasing_id())
    return materialize(laid, "sliced").withColumn(SLICE, F.shiftright(AT, 33))


def _carry_join(rows: DataFrame, segments: DataFrame, by: Sequence[str]) -> DataFrame:
    renamed = segments.select(
        F.col(SLICE).alias("_cslice"), *[F.col(c).alias(f"_c_{c}") for c in by], "_carry"
    )
    match = rows[SLICE] == renamed["_cslice"]
    for c in by:
        match = match & rows[c].eqNullSafe(renamed[f"_c_{c}"])
    return rows.join(F.broadcast(renamed), match, "left").drop("_cslice", *[f"_c_{c}" for c in by])


def sliced_window(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    local: Callable[[Window], Column],
    segment: Column,
    carry: Callable[[Window], Column],
    combine: Callable[[Column, Column], Column],
    name: str,
) -> DataFrame:
    """``local`` inside a slice, combined with ``carry`` of the ``segment`` values of earlier slices."""
    laid = range_sliced(df, by, order)
    earlier = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    segments = laid.groupBy(SLICE, *by).agg(segment.alias("_segment"))
    carried = segments.withColumn("_carry", carry(earlier)).where(F.col("_carry").isNotNull())
    inside = Window.partitionBy(SLICE, *by).orderBy(AT)
    rows = laid.withColumn("_local", local(inside))
    joined = _carry_join(rows, carried, by)
    return joined.withColumn(name, combine(F.col("_local"), F.col("_carry"))).drop("_local", "_carry", AT, SLICE)


def ranked(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Exact ``row_number`` over (by, order)."""
    if by:
        return sliced_window(
            df, by, order,
            local=lambda w: F.row_number().over(w).cast("long"),
            segment=F.count(F.lit(1)),
            carry=lambda w: F.sum("_segment").over(w),
            combine=lambda here, before: here + F.coalesce(before, F.lit(0)),
            name=name,
        )
    # without groups the position inside the slice is the local rank already
    laid = range_sliced(df, (), order)
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        laid.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_carry", F.sum("_n").over(earlier))
        .where(F.col("_carry").isNotNull())
    )
    here = F.col(AT) - F.shiftleft(F.col(SLICE), 33) + 1
    return _carry_join(laid, carried, ()).withColumn(name, here + F.coalesce("_carry", F.lit(0))).drop("_carry", AT, SLICE)


def running_sum(df: DataFrame, value: Column, order: Sequence[Column], by: Sequence[str], name: str) -> DataFrame:
    """Exact running total over (by, order), the current row included."""
    return sliced_window(
        df.withColumn("_value", value), by, order,
        local=lambda w: F.sum("_value").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        segment=F.sum("_value"),
        carry=lambda w: F.sum("_segment").over(w),
        combine=lambda here, before: here + F.coalesce(before, F.lit(0)),
        name=name,
    ).drop("_value")


def previous(
    df: DataFrame, value: str, order: Sequence[Column], by: Sequence[str], name: str, nullable: bool = True
) -> DataFrame:
    """Exact ``lag`` of one column over (by, order); a column without nulls needs no box and aggregates faster."""
    boxed = F.struct(F.col(value).alias("v")) if nullable else F.col(value)
    return sliced_window(
        df, by, order,
        local=lambda w: F.lag(boxed).over(w),
        segment=F.max_by(boxed, F.col(AT)),
        carry=lambda w: F.last("_segment").over(w),
        combine=lambda here, before: F.coalesce(here, before)["v"] if nullable else F.coalesce(here, before),
        name=name,
    )
