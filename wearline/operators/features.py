"""The feature table: remaining life, labels, rolling statistics, operating mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.functions.labels import binary_label, remaining_life, three_class_label
from wearline.operators.layout import MAX_GROUP_ROWS, Layout, measure
from wearline.operators.opmodes import OpModeModel
from wearline.operators.rolling import with_rolling_stats
from wearline.schema import KINDS, SENSORS, SETTINGS, WINDOW_ROWS


def last_cycle(readings: DataFrame, keys: Sequence[str] = ("run_id", "id")) -> DataFrame:
    """Last observed cycle of every engine."""
    return readings.groupBy(*keys).agg(F.max("cycle").alias("last_cycle"))


def _of_run(df: DataFrame, run_id: str | None, needed: Sequence[str]) -> DataFrame:
    """Rows of one run without their run_id, or all runs with it."""
    if run_id is None:
        return df.select("run_id", *needed)
    if "run_id" in df.columns:
        df = df.where(F.col("run_id") == run_id)
    return df.select(*needed)


def build_features(
    readings: DataFrame,
    kind: str,
    *,
    run_id: str | None = None,
    truth: DataFrame | None = None,
    op_modes: DataFrame | OpModeModel | None = None,
    window_rows: int = WINDOW_ROWS,
    settings: Sequence[str] = SETTINGS,
    sensors: Sequence[str] = SENSORS,
    ordered: bool = False,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """Feature table of one run, or of all runs at once when ``run_id`` is None.

    ``kind='train'``: engines run to failure, so life ends at the last cycle.
    ``kind='test'``: ``truth`` (id, rul_at_maxcycle) says how long each engine
    lives on; engines without truth drop out. ``op_modes`` is a table (id, cycle,
    operationmode), joined left, or a fitted model, applied to the rows before
    the shuffle without a join. ``max_group_rows`` and ``block_rows`` steer
    how long engines are cut into blocks; they do not change the result.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be 'train' or 'test', got {kind!r}")
    if kind == "test" and truth is None:
        raise ValueError("kind 'test' needs the truth table")

    keys = ("run_id", "id") if run_id is None else ("id",)
    measured = [*settings, *sensors]
    base = _of_run(readings, run_id, ["id", "cycle", *measured])
    if isinstance(op_modes, OpModeModel):
        base = op_modes.transform(base)
    # Blocks of at least a frame each, so that carried rows at most double a panel.
    layout = measure(
        base, keys, ["cycle"], max_group_rows=max_group_rows, block_rows=block_rows, least_rows=max(1, window_rows)
    )
    rows, end = with_rolling_stats(base, layout, sensors, window_rows)

    # The modes come first: their join keeps the order by cycle that the truth join can reuse.
    if isinstance(op_modes, DataFrame):
        rows = _join_op_modes(rows, op_modes, run_id, layout)
    beyond = None
    if kind == "test":
        known = layout.place_groups(_of_run(truth, run_id, ["id", "rul_at_maxcycle"]))
        rows = rows.join(known, list(layout.placed_by), "inner")
        beyond = F.col("rul_at_maxcycle")
    rows = rows.withColumn("rul", remaining_life(F.col(end), F.col("cycle"), beyond))

    stats = [f"{prefix}{j}" for j in range(1, len(sensors) + 1) for prefix in ("a", "sd")]
    out = rows.select(
        *keys,
        "cycle",
        *measured,
        "rul",
        binary_label(F.col("rul")).alias("label1"),
        three_class_label(F.col("rul")).alias("label2"),
        *(["operationmode"] if op_modes is not None else []),
        *stats,
    )
    return out.orderBy(*keys, "cycle") if ordered else out


def _join_op_modes(
    rows: DataFrame, op_modes: DataFrame, run_id: str | None, layout: Layout
) -> DataFrame:
    if run_id is None and "run_id" not in op_modes.columns:
        raise ValueError("operating modes of several runs need a run_id column")
    modes = _of_run(op_modes, run_id, ["id", "cycle", "operationmode"])
    placed = layout.place(modes).select(*layout.placed_by, "cycle", "operationmode")
    return rows.join(placed, [*layout.placed_by, "cycle"], "left")
