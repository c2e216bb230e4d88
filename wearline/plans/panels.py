"""Sensor panels made from the driver's tables.

A panel is one row per engine and cycle. From ``events`` an engine is a user and
a cycle the user's n-th event; from ``orders`` an engine is a customer and the
order number is the time, with gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.operators.layout import MAX_GROUP_ROWS, ordinal

EVENT_SETTINGS = ("setting1", "setting2", "setting3")
EVENT_SENSORS = ("s1", "s2", "s3")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_panel(
    spark: SparkSession,
    sf_dir: str,
    *,
    engine: Column | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``run_id, id, cycle, setting1..3, s1..s3, event_type``; engines are users unless ``engine`` says otherwise.

    Settings: hour, weekday, a constant. Sensors: value, the number in props,
    and hours since the start of the month, which wear on with the cycles.
    """
    hour, day = F.hour("ts").cast("double"), F.dayofmonth("ts").cast("double")
    # Keys get their final names here, so that the windows to come share one shuffle.
    rows = table(spark, sf_dir, "events").select(
        F.lit("ev").alias("run_id"),
        (F.col("user_id") if engine is None else engine).alias("id"),
        "ts",
        "event_id",
        hour.alias("setting1"),
        (F.weekday("ts") + 1).cast("double").alias("setting2"),
        F.lit(100.0).alias("setting3"),
        F.col("value").alias("s1"),
        F.regexp_extract("props", "[0-9]+", 0).cast("double").alias("s2"),
        ((day - 1) * 24 + hour).alias("s3"),
        "event_type",
    )
    numbered = ordinal(rows, ["id"], ["ts", "event_id"], "cycle", max_group_rows=max_group_rows)
    return numbered.select(
        "run_id", "id", "cycle", *EVENT_SETTINGS, *EVENT_SENSORS, "event_type"
    )


def runs_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events panel as five runs, one per event type; cycles have gaps inside a run."""
    return events_panel(spark, sf_dir).withColumn("run_id", F.col("event_type"))


def wide_panel(spark: SparkSession, sf_dir: str, sensors: int = 21) -> DataFrame:
    """The events panel with ``sensors`` sensors ``s_j = value + j * k``."""
    panel = events_panel(spark, sf_dir)
    made = [(F.col("s1") + j * F.col("s2")).alias(f"s{j}") for j in range(1, sensors + 1)]
    return panel.select("run_id", "id", "cycle", *EVENT_SETTINGS, *made)


def worn_panel(spark: SparkSession, sf_dir: str, sensors: int = 21) -> DataFrame:
    """The events panel with its own three sensors, of which the last wears on, and mixtures of the first two as the others."""
    panel = events_panel(spark, sf_dir)
    made = [(F.col("s1") + j * F.col("s2")).alias(f"s{j}") for j in range(len(EVENT_SENSORS) + 1, sensors + 1)]
    return panel.select("run_id", "id", "cycle", *EVENT_SETTINGS, *EVENT_SENSORS, *made)


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, id, cycle, price``: customers over their order numbers."""
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("run_id"),
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("cycle"),
        F.col("o_totalprice").alias("price"),
    )


def orders_truth(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """``run_id, id, rul_at_maxcycle``: number of orders of each customer, of all orders unless given."""
    return (
        (table(spark, sf_dir, "orders") if orders is None else orders)
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.count(F.lit(1)).cast("int").alias("rul_at_maxcycle"))
        .select(F.lit("ev").alias("run_id"), "id", "rul_at_maxcycle")
    )


def sensor_lines(panel: DataFrame, sensors=EVENT_SENSORS) -> DataFrame:
    """Sensor log lines of a panel; NULL is an empty field."""
    fields = ["id", "cycle", *EVENT_SETTINGS, *sensors]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    return panel.select(F.concat_ws(" ", *text).alias("value"))
