"""Rolling statistics over the last rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.operators.layout import LAST, START, Layout

_LAST_TIME = "_group_last"
# Longer frames are put together from moments, at a cost that does not depend on their length.
MAX_DIRECT_ROWS = 10


def _direct(placed: DataFrame, layout: Layout, columns: Sequence[str], window_rows: int) -> DataFrame:
    """Each frame is aggregated by itself."""
    by_time = Window.partitionBy(*layout.placed_by).orderBy(layout.time)
    frame = by_time.rowsBetween(1 - window_rows, Window.currentRow)
    stats = {}
    for j, name in enumerate(columns, start=1):
        stats[f"a{j}"] = F.avg(name).over(frame)
        stats[f"sd{j}"] = F.stddev_samp(name).over(frame)
    return placed.withColumns(stats)


def _moments(name: str, window) -> Column:
    """Count, mean and sum of squared deviations; NULLs are skipped."""
    n = F.count(name).over(window)
    return F.struct(
        n.cast("double").alias("n"),
        F.coalesce(F.avg(name).over(window), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(name).over(window) * n, F.lit(0.0)).alias("squares"),
    )


def _merged(a: Column, b: Column) -> tuple[Column, Column]:
    """Mean and sample deviation of two sets of rows from their moments."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    squares = a["squares"] + b["squares"] + apart * apart * a["n"] * b["n"] / n
    mean = (a["n"] * a["mean"] + b["n"] * b["mean"]) / n
    return F.when(n > 0, mean), F.when(n > 1, F.sqrt(squares / (n - 1)))


def _from_moments(placed: DataFrame, layout: Layout, columns: Sequence[str], window_rows: int) -> DataFrame:
    """Each frame is the end of one stretch of ``window_rows`` rows and the beginning of the next.

    Moments of all beginnings and of all ends are running aggregates of the stretches, so a row costs the same
    for any length of the frame; sums that grow and shrink, which lose digits and never recover from
    a NaN, are avoided.
    """
    by_time = Window.partitionBy(*layout.placed_by).orderBy(layout.time)
    place = F.row_number().over(by_time) - 1
    rows = placed.withColumn("_place", place).withColumn("_stretch", F.expr(f"_place div {window_rows}"))
    stretch = Window.partitionBy(*layout.placed_by, "_stretch")
    upto = (Window.unboundedPreceding, Window.currentRow)
    back = stretch.orderBy(F.desc(layout.time)).rowsBetween(*upto)
    ahead = stretch.orderBy(layout.time).rowsBetween(*upto)
    in_order = Window.partitionBy(*layout.placed_by).orderBy("_stretch", layout.time)
    names = [f"m{j}" for j in range(1, len(columns) + 1)]
    rows = rows.withColumn("_ends", F.struct(*[_moments(c, back).alias(m) for m, c in zip(names, columns, strict=True)]))
    rows = rows.withColumn("_begins", F.struct(*[_moments(c, ahead).alias(m) for m, c in zip(names, columns, strict=True)]))
    # The last row of a stretch has all of its frame in it.
    earlier = F.lag("_ends", window_rows - 1).over(in_order)
    rows = rows.withColumn("_earlier", F.when(F.col("_place") % window_rows != window_rows - 1, earlier))
    stats = {}
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    for j, m in enumerate(names, start=1):
        a, b = F.coalesce(F.col(f"_earlier.{m}"), none), F.col(f"_begins.{m}")
        stats[f"a{j}"], stats[f"sd{j}"] = _merged(a, b)
    return rows.withColumns(stats).drop("_place", "_stretch", "_ends", "_begins", "_earlier")


def with_rolling_stats(
    df: DataFrame, layout: Layout, columns: Sequence[str], window_rows: int
) -> tuple[DataFrame, str]:
    """Add ``a<j>`` (mean) and ``sd<j>`` (sample deviation) of the j-th column over a row frame.

    The frame is the current row and the ``window_rows - 1`` rows before it in
    time; NULLs are skipped. Also adds the last time of the group, whose column
    name is returned, since all windows share one shuffle.
    """
    if window_rows < 1:
        raise ValueError(f"window_rows must be at least 1, got {window_rows}")
    split = layout.long is not None
    placed = layout.place(df, carried=window_rows - 1)
    rolled = _direct if window_rows <= MAX_DIRECT_ROWS else _from_moments
    out = rolled(placed, layout, columns, window_rows)
    # The ordered windows come first: their sort also clusters the groups for the maximum.
    whole = Window.partitionBy(*layout.placed_by)
    out = out.withColumn(_LAST_TIME, F.max(layout.time).over(whole))
    if split:
        # Rows carried over from earlier blocks have done their part.
        own = F.col(LAST).isNull() | F.col(START).isNotNull()
        out = out.where(own).withColumn(_LAST_TIME, F.coalesce(LAST, _LAST_TIME)).drop(LAST, START)
    return out, _LAST_TIME
