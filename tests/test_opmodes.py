from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler

from wearline.operators import opmodes
from wearline.operators.features import build_features
from wearline.operators.opmodes import OpModeModel, fit_op_modes, nearest_centre

# Six settings an engine is run at, far apart in at least one of three dials.
LEVELS = [(2, 40, 7), (2, 40, 90), (30, 40, 7), (30, 5, 7), (61, 5, 90), (61, 70, 50)]


@pytest.fixture(scope="module")
def points(spark):
    rows = []
    for true_mode, level in enumerate(LEVELS):
        for step in range(5):
            settings = [x + 0.02 * math.cos(step + true_mode + 3 * j) for j, x in enumerate(level)]
            rows.append((len(rows) + 1, 1, *settings, true_mode))
    return spark.createDataFrame(
        rows, "id int, cycle int, setting1 double, setting2 double, setting3 double, true_mode int"
    )


def spread_around_means(points) -> float:
    """The sum of squared distances of all points from the means of their true modes."""
    rows = points.collect()
    total = 0.0
    for mode in range(len(LEVELS)):
        mine = np.array([tuple(r)[2:5] for r in rows if r.true_mode == mode])
        total += ((mine - mine.mean(axis=0)) ** 2).sum()
    return total


@pytest.fixture(scope="module")
def model(points):
    return fit_op_modes(points)


def test_recovers_separated_clusters(points, model):
    assert [len(c) for c in model.centres] == [3] * 6
    rows = model.transform(points).collect()
    modes = {t: {r.operationmode for r in rows if r.true_mode == t} for t in range(6)}
    assert all(len(m) == 1 for m in modes.values())
    assert len(set.union(*modes.values())) == 6
    assert model.cost == pytest.approx(spread_around_means(points))


def test_same_seed_same_model(points, model):
    again = fit_op_modes(points.repartition(5))
    np.testing.assert_allclose(again.centres, model.centres)
    assert sorted(again.assign(points).collect()) == sorted(model.assign(points).collect())


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_same_model_for_any_spread(spark, points, model, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        again = fit_op_modes(points.repartition(int(partitions) + 1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert again.centres == model.centres and again.cost == model.cost


def test_all_fits_share_their_passes(points, monkeypatch):
    passes = []
    moved = opmodes._moved
    monkeypatch.setattr(opmodes, "_moved", lambda *args: passes.append(1) or moved(*args))
    one = fit_op_modes(points, restarts=1)
    alone = len(passes)
    passes.clear()
    many = fit_op_modes(points, restarts=10)
    assert len(passes) < 4 * alone
    assert many.cost <= one.cost


def test_centres_are_the_means_of_their_points(points, model):
    rows = model.transform(points).groupBy("operationmode").avg("setting1", "setting2", "setting3").collect()
    for r in rows:
        np.testing.assert_allclose(r[1:], model.centres[r.operationmode], rtol=1e-9)


def test_settings_must_be_numbers(spark, model):
    schema = "id int, cycle int, setting1 double, setting2 double, setting3 double"
    for bad in (None, float("nan")):
        rows = spark.createDataFrame([(1, 1, bad, 0.0, 0.0), *[(1, c, float(c), 0.0, 0.0) for c in range(2, 9)]], schema)
        with pytest.raises(ValueError, match="NULLs or NaNs"):
            fit_op_modes(rows)
        with pytest.raises(Exception, match="must not be NULL or NaN"):
            model.transform(rows).collect()


def test_repeated_points_weigh_as_rows(spark, points):
    tripled = points.unionByName(points).unionByName(points)
    merged = fit_op_modes(tripled, restarts=2)
    assert merged.cost == pytest.approx(3 * fit_op_modes(points, restarts=2).cost)


def test_save_and_load(spark, points, model, tmp_path):
    path = str(tmp_path / "nested" / "modes")
    model.save(path)
    loaded = OpModeModel.load(spark, path)
    assert loaded.settings == model.settings == ("setting1", "setting2", "setting3")
    assert sorted(loaded.assign(points).collect()) == sorted(model.assign(points).collect())


def test_load_of_something_else(spark, points, tmp_path):
    path = str(tmp_path / "other")
    stage = VectorAssembler(inputCols=["setting1"], outputCol="v")
    PipelineModel(stages=[stage]).save(path)
    with pytest.raises(TypeError, match="VectorAssembler"):
        OpModeModel.load(spark, path)


def test_too_few_rows(points):
    with pytest.raises(ValueError, match="need at least 6 rows"):
        fit_op_modes(points.limit(3))


def test_fewer_points_than_modes(readings):
    model = fit_op_modes(readings, k=2)
    out = build_features(readings, "train", run_id="SYN", op_modes=model)
    assert len(model.centres) == 1
    assert {r.operationmode for r in out.collect()} == {0}
    assert dict(out.dtypes)["operationmode"] == "bigint"
    plain = build_features(readings, "train", run_id="SYN")
    assert "operationmode" not in plain.columns
    assert out.drop("operationmode").columns == plain.columns


def test_model_and_table_give_the_same_feature_column(readings, points, model):
    by_model = build_features(readings, "train", run_id="SYN", op_modes=model, ordered=True)
    table = model.assign(readings, ["run_id", "id", "cycle"])
    by_table = build_features(readings, "train", run_id="SYN", op_modes=table, ordered=True)
    assert by_model.collect() == by_table.collect()


def test_nearest_centre_agrees_with_the_model(points, model):
    fixed = nearest_centre(points, model.centres).select("id", "cycle", "operationmode")
    assert sorted(fixed.collect()) == sorted(model.assign(points).collect())
