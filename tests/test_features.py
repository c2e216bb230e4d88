from __future__ import annotations

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of, synthetic_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wearline import schema
from wearline.operators import rolling
from wearline.operators.features import build_features, last_cycle
from wearline.operators.layout import measure, ordinal
from wearline.operators.rolling import with_rolling_stats

# Id, cycle, rul, label1, label2, a1, sd1, a21 of the fixture.
GOLD = [
    (1, 1, 5, 1, 2, 1.0, None, 21.0),
    (1, 2, 4, 1, 2, 1.5, 0.7071067811865476, 21.5),
    (1, 3, 3, 1, 2, 2.0, 1.0, 22.0),
    (1, 4, 2, 1, 2, 2.5, 1.2909944487358056, 22.5),
    (1, 5, 1, 1, 2, 3.0, 1.5811388300841898, 23.0),
    (1, 6, 0, 1, 2, 4.0, 1.5811388300841898, 24.0),
    (2, 1, 2, 1, 2, 10.0, None, 210.0),
    (2, 2, 1, 1, 2, 15.0, 7.0710678118654755, 215.0),
    (2, 3, 0, 1, 2, 20.0, 10.0, 220.0),
]
SPLIT = {"max_group_rows": 2, "block_rows": 2}


@pytest.mark.parametrize("options", [{}, SPLIT, {"max_group_rows": 4, "block_rows": 3}])
def test_train_gold(readings, options):
    out = build_features(readings, "train", run_id="SYN", ordered=True, **options)
    rows = out.select("id", "cycle", "rul", "label1", "label2", "a1", "sd1", "a21").collect()
    assert len(rows) == len(GOLD)
    for row, gold in zip(rows, GOLD, strict=True):
        assert tuple(row)[:5] == gold[:5]
        for value, expected in zip(tuple(row)[5:], gold[5:], strict=True):
            assert value is expected or value == pytest.approx(expected, rel=1e-12)


def test_column_order_and_types(readings):
    out = build_features(readings, "train", run_id="SYN")
    stats = [f"{p}{j}" for j in range(1, 22) for p in ("a", "sd")]
    assert out.columns == [
        "id", "cycle", *schema.SETTINGS, *schema.SENSORS, "rul", "label1", "label2", *stats,
    ]
    types = dict(out.dtypes)
    assert {types[c] for c in ("id", "cycle", "rul", "label1", "label2")} == {"int"}
    assert {types[c] for c in stats} == {"double"}


@pytest.mark.parametrize("options", [{}, SPLIT])
@pytest.mark.parametrize(
    ("truth", "ruls", "labels"),
    [
        (
            [(1, 100), (2, 50)],
            {1: [105, 104, 103, 102, 101, 100], 2: [52, 51, 50]},
            {1: [(0, 0)] * 6, 2: [(0, 0)] * 3},
        ),
        (
            [(1, 10), (2, 29)],
            {1: [15, 14, 13, 12, 11, 10], 2: [31, 30, 29]},
            {1: [(1, 2)] * 6, 2: [(0, 0), (1, 1), (1, 1)]},
        ),
        (
            [(1, 11), (9, 5)],
            {1: [16, 15, 14, 13, 12, 11]},
            {1: [(1, 1)] + [(1, 2)] * 5},
        ),
    ],
)
def test_test_kind_gold(spark, readings, truth, ruls, labels, options):
    known = spark.createDataFrame([("SYN", *t) for t in truth], schema.TRUTH)
    out = build_features(readings, "test", run_id="SYN", truth=known, ordered=True, **options)
    found, marked = {}, {}
    for row in out.collect():
        found.setdefault(row.id, []).append(row.rul)
        marked.setdefault(row.id, []).append((row.label1, row.label2))
    assert found == ruls
    assert marked == labels


@pytest.mark.parametrize("kind", ["train", "test"])
@pytest.mark.parametrize("with_modes", [False, True])
def test_empty_inputs_bind(spark, kind, with_modes):
    modes = spark.createDataFrame([], "id int, cycle int, operationmode long")
    out = build_features(
        spark.createDataFrame([], schema.READINGS),
        kind,
        run_id="X",
        truth=spark.createDataFrame([], schema.TRUTH),
        op_modes=modes if with_modes else None,
    )
    assert out.count() == 0
    assert ("operationmode" in out.columns) == with_modes
    assert len(out.columns) == 2 + 3 + 21 + 3 + 42 + with_modes


def test_unknown_kind_and_missing_truth(readings):
    with pytest.raises(ValueError, match="kind must be"):
        build_features(readings, "validation")
    with pytest.raises(ValueError, match="truth"):
        build_features(readings, "test")
    with pytest.raises(ValueError, match="window_rows"):
        build_features(readings, "train", window_rows=0)


@pytest.mark.parametrize("options", [{}, SPLIT])
def test_op_modes_join_keeps_unmatched_and_multiplies_duplicates(spark, readings, options):
    modes = spark.createDataFrame(
        [(1, 1, 4), (1, 2, 5), (1, 2, 6), (7, 1, 1)], "id int, cycle int, operationmode long"
    )
    out = build_features(readings, "train", run_id="SYN", op_modes=modes, **options)
    got = sorted(
        (r.id, r.cycle, r.operationmode or 0)
        for r in out.select("id", "cycle", "operationmode").collect()
    )
    assert got[:3] == [(1, 1, 4), (1, 2, 5), (1, 2, 6)]
    assert all(mode == 0 for _, _, mode in got[3:])
    assert len(got) == 10


def test_runs_do_not_mix(spark, readings):
    other = readings.withColumn("run_id", F.lit("B")).withColumn("s1", F.col("s1") * 2)
    both = readings.unionByName(other)
    out = build_features(both, "train").where("run_id = 'SYN'").drop("run_id")
    alone = build_features(readings, "train", run_id="SYN")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, alone.collect()), key=str)
    modes = spark.createDataFrame([], "id int, cycle int, operationmode long")
    with pytest.raises(ValueError, match="run_id"):
        build_features(both, "train", op_modes=modes)


def test_last_cycle(readings):
    assert {(r.id, r.last_cycle) for r in last_cycle(readings).collect()} == {(1, 6), (2, 3)}


def rolled_by_sql(rows: list[tuple], window: int) -> list[tuple]:
    """id, cycle, rul, a1, sd1 of rows (id, cycle, s1), ordered, by another engine."""
    panel = pa.table(list(zip(*rows, strict=True)) or [[]] * 3, names=["id", "cycle", "s1"])  # noqa: F841
    return duckdb.sql(f"""
        SELECT id, cycle, max(cycle) OVER (PARTITION BY id) - cycle AS rul,
               avg(s1::DOUBLE) OVER w AS a1, stddev_samp(s1::DOUBLE) OVER w AS sd1
        FROM panel
        WINDOW w AS (PARTITION BY id ORDER BY cycle ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)
        ORDER BY id, cycle""").fetchall()


def assert_same_features(found: list[tuple], wanted: list[tuple]) -> None:
    assert [r[:3] for r in found] == [r[:3] for r in wanted]
    numbers = [np.array([[np.nan if x is None else x for x in r[3:]] for r in rows]) for rows in (found, wanted)]
    np.testing.assert_allclose(*numbers, rtol=1e-9, atol=1e-9, equal_nan=True)


def of_one_sensor(panel, window: int, **options) -> list[tuple]:
    out = build_features(panel, "train", run_id="X", settings=[], sensors=["s1"], window_rows=window, **options)
    return sorted(map(tuple, out.select("id", "cycle", "rul", "a1", "sd1").collect()))


panels = st.dictionaries(
    st.integers(0, 4),
    st.dictionaries(st.integers(-40, 60), st.none() | st.integers(-9, 9), min_size=1, max_size=40),
    min_size=1,
    max_size=4,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    engines=panels,
    window=st.integers(1, 9),
    block_rows=st.integers(1, 12),
    max_group_rows=st.integers(0, 20),
)
def test_split_engines_match_whole_ones(spark, engines, window, block_rows, max_group_rows):
    """Any cut of long engines, with gaps in time, gives the frames of the uncut engine."""
    rows = [
        (i, c, None if v is None else float(v)) for i, values in engines.items() for c, v in values.items()
    ]
    panel = spark.createDataFrame(rows, "id int, cycle int, s1 double")
    found = of_one_sensor(panel, window, max_group_rows=max_group_rows, block_rows=block_rows)
    assert_same_features(found, rolled_by_sql(rows, window))


def times(kind: str, n: int) -> list[int]:
    """``n`` different times: one after the other, far apart, or half of them in a millionth of the whole span."""
    if kind == "dense":
        return list(range(n))
    if kind == "sparse":
        return [(i * 600) ** 3 for i in range(n)]
    if kind == "negative":
        return [(i - n // 2) * 10**12 for i in range(n)]
    return [i for i in range(n // 2)] + [10**6 * n + i * 10**6 for i in range(n - n // 2)]


def sizes_of_blocks(layout) -> dict:
    """Rows per block of each long group."""
    return {r["id"]: np.diff(r["_starts"]).tolist() for r in layout.long.collect()}


@pytest.mark.parametrize("kind", ["dense", "sparse", "negative", "skewed"])
def test_blocks_hold_bounded_rows(spark, kind):
    rows = [(1, t) for t in times(kind, 3000)] + [(2, t) for t in times("dense", 90)] + [(3, 5)]
    panel = spark.createDataFrame(rows, "id int, cycle long").repartition(5)
    layout = measure(panel, ["id"], ["cycle"], max_group_rows=50, block_rows=100)
    sizes = sizes_of_blocks(layout)
    assert {i: sum(s) for i, s in sizes.items()} == {1: 3000, 2: 90}
    for blocks in sizes.values():
        assert max(blocks) <= 100
        assert all(a + b > 50 for a, b in zip(blocks, blocks[1:]))
    # The rows really lie as the layout says, in the order of time.
    placed = layout.place(panel).groupBy("id", "_block").agg(F.count("*").alias("n"), F.min("cycle").alias("first"))
    found = {}
    for r in placed.orderBy("id", "first").collect():
        found.setdefault(r.id, []).append(r.n)
    assert found == {**sizes, 3: [1]}


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date"])
def test_blocks_of_a_busy_moment_are_cut_by_the_next_column(spark, kind):
    """A single time with half of all rows falls apart into several blocks; so do the rows around it."""
    n = 1200
    rows = spark.range(n).selectExpr(
        "cast(1 as int) AS id", "id AS event",
        f"cast(timestamp'2024-01-01' + make_interval(0, 0, 0, if(id % 2 = 0, 7, cast(id as int))) as {kind}) AS at",
    )
    layout = measure(rows, ["id"], ["at", "event"], max_group_rows=50, block_rows=60)
    (blocks,) = sizes_of_blocks(layout).values()
    assert sum(blocks) == n and max(blocks) <= 60
    numbered = ordinal(rows, ["id"], ["at", "event"], "n", max_group_rows=50, block_rows=60)
    found = [r.n for r in numbered.orderBy("at", "event").collect()]
    assert found == list(range(1, n + 1))
    assert dict(numbered.dtypes)["n"] == "int"


def test_rows_of_one_order_key_share_a_block(spark):
    rows = spark.range(500).selectExpr("cast(1 as int) AS id", "if(id < 300, 7, id) AS cycle")
    (blocks,) = sizes_of_blocks(measure(rows, ["id"], ["cycle"], max_group_rows=10, block_rows=20)).values()
    assert max(blocks) >= 300 and sum(blocks) == 500


def test_text_is_no_order_for_long_groups(spark):
    rows = spark.range(50).selectExpr("1 AS id", "cast(id as string) AS at")
    assert measure(rows, ["id"], ["at"], max_group_rows=50).long is None
    with pytest.raises(ValueError, match="integers, dates or timestamps"):
        measure(rows, ["id"], ["at"], max_group_rows=10)


@pytest.mark.parametrize("kind, window", [("skewed", 5), ("dense", 51), ("skewed", 51)])
def test_rows_carried_over_are_at_most_a_frame_per_block(spark, window, kind):
    rows = [(1, t, float(t % 17)) for t in times(kind, 2000)]
    panel = spark.createDataFrame(rows, "id int, cycle long, s1 double")
    layout = measure(panel, ["id"], ["cycle"], max_group_rows=20, block_rows=8, least_rows=window)
    (blocks,) = sizes_of_blocks(layout).values()
    placed = layout.place(panel, carried=window - 1)
    counts = placed.groupBy("_block").agg(
        F.count("*").alias("n"), F.count_if(F.col("_start").isNull()).alias("carried")
    )
    counts = counts.collect()
    assert max(r.carried for r in counts) <= window - 1
    assert sum(r.n for r in counts) <= 2000 + (window - 1) * len(blocks) < 5000
    assert max(r.n for r in counts) <= 2 * max(4, window) + window - 1
    assert_same_features(
        of_one_sensor(panel, window, max_group_rows=20, block_rows=8), rolled_by_sql(rows, window)
    )


@pytest.mark.parametrize("block_rows", [2, 16])
def test_frames_over_many_small_blocks(spark, block_rows):
    """Blocks shorter than a frame: the rows of several of them are carried into the next."""
    rows = [(1, t, float((t * t) % 23)) for t in times("skewed", 150)]
    panel = spark.createDataFrame(rows, "id int, cycle long, s1 double")
    layout = measure(panel, ["id"], ["cycle"], max_group_rows=3, block_rows=block_rows)
    out, end = with_rolling_stats(panel, layout, ["s1"], 19)
    found = sorted(map(tuple, out.select("id", "cycle", F.col(end) - F.col("cycle"), "a1", "sd1").collect()))
    assert_same_features(found, rolled_by_sql(rows, 19))


@pytest.mark.parametrize("options", [{}, {"max_group_rows": 60, "block_rows": 40}])
@pytest.mark.parametrize("window", [11, 64, 1000])
def test_long_frames_from_moments(spark, window, options):
    rows = [
        (i, c, None if c % 7 == i else 1e6 + math.sin(c * i) * 10 ** (c % 4))
        for i, n in ((1, 400), (2, 31), (3, 1), (4, 25))
        for c in range(0, 3 * n, 3)
    ]
    panel = spark.createDataFrame(rows, "id int, cycle int, s1 double").repartition(3)
    assert_same_features(of_one_sensor(panel, window, **options), rolled_by_sql(rows, window))


def test_moments_forget_what_leaves_the_frame(spark, monkeypatch):
    """After a NaN or an infinity has left the frame, statistics are those of the rows in it."""
    odd = {30: float("nan"), 90: float("inf"), 91: float("-inf"), 150: None}
    rows = [(1, c, odd.get(c, float(c % 11))) for c in range(260)]
    panel = spark.createDataFrame(rows, "id int, cycle int, s1 double")
    by_moments = of_one_sensor(panel, 30)
    monkeypatch.setattr(rolling, "MAX_DIRECT_ROWS", 30)
    direct = of_one_sensor(panel, 30)
    assert_same_features(by_moments, direct)
    assert not any(math.isnan(x) for r in by_moments if r[1] >= 121 for x in r[3:])


def test_plan_of_long_frames_moves_rows_once(spark, readings, tmp_path):
    path = str(tmp_path / "readings")
    readings.write.parquet(path)
    plan = plan_of(build_features(spark.read.parquet(path), "train", run_id="SYN", window_rows=500))
    assert plan.count("Exchange") == 1 and "Join" not in plan
    # No frame is aggregated row by row: all of them start or end with their stretch.
    assert "499" not in "".join(line for line in plan.splitlines() if "avg(" in line and "lag(" not in line)


@pytest.mark.parametrize("max_group_rows", [None, 0, 5, 1000])
def test_ordinal_numbers_rows_of_long_groups(spark, max_group_rows):
    rows = [(g, (7 * i) % 31, i) for g, n in (("a", 40), ("b", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, at int, tie int")
    out = ordinal(
        df,
        ["g"],
        ["at", "tie"],
        "n",
        max_group_rows=max_group_rows,
        block_rows=4,
    )
    want = [
        (g, at, tie, n)
        for name in ("a", "b")
        for n, (g, at, tie) in enumerate(sorted(r for r in rows if r[0] == name), start=1)
    ]
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_plan_of_short_engines_is_one_shuffle_and_one_sort(spark, readings, tmp_path):
    path = str(tmp_path / "readings")
    readings.write.parquet(path)
    plan = plan_of(build_features(spark.read.parquet(path), "train", run_id="SYN"))
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1
    assert "Join" not in plan


def test_plan_of_long_engines_shuffles_rows_once(spark, readings, tmp_path):
    """One exchange of the rows and their halo; the rest ranks block ends of long engines."""
    path = str(tmp_path / "readings")
    readings.write.parquet(path)
    out = build_features(spark.read.parquet(path), "train", run_id="SYN", **SPLIT)
    plan = plan_of(out)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("kind", ["train", "test"])
def test_long_engines_hashed_by_id_move_by_block(spark, kind):
    panel = spark.range(4000).selectExpr("cast(id % 2 as int) AS id", "cast(id as int) AS cycle", "double(id) AS s1")
    truth = spark.createDataFrame([(0, 5), (1, 6)], "id int, rul_at_maxcycle int")
    options = {"run_id": "X", "settings": [], "sensors": ["s1"], "max_group_rows": 100, "block_rows": 64}
    out = build_features(panel.repartition(4, "id"), kind, truth=truth if kind == "test" else None, **options)
    assert "hashpartitioning(_block" in plan_of(out)
    assert out.count() == 4000
    # Without merging of small partitions, no task holds the rows of one engine.
    few = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        tasks = out.select("a1", "rul", F.spark_partition_id().alias("task")).collect()
        assert max(np.bincount([r.task for r in tasks])) < 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("id_kind", ["int", "long"])
def test_truth_of_long_engines_with_far_cycles(spark, id_kind):
    rows = [(1, n * 10**13, float(n)) for n in range(10)] + [(2, 1, 1.0)]
    panel = spark.createDataFrame(rows, "id int, cycle long, s1 double")
    truth = spark.createDataFrame([(1, 7), (2, 3)], f"id {id_kind}, rul_at_maxcycle int")
    whole, cut = (
        build_features(panel, "test", run_id="X", truth=truth, settings=[], sensors=["s1"], max_group_rows=n)
        .select("id", "cycle", "rul", "a1", "sd1")
        .orderBy("id", "cycle")
        .collect()
        for n in (None, 5)
    )
    assert cut == whole and len(cut) == len(rows)


def test_raw_rows_are_the_fixture(readings):
    assert sorted(tuple(r)[1:] for r in readings.collect()) == synthetic_rows()
