from __future__ import annotations

import pytest

from wearline.operators import catalogue, quality
from wearline.operators.quality import ConstraintViolation


@pytest.fixture
def child(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None)], "k int, v string")


def test_duplicate_keys(child):
    assert [tuple(r) for r in quality.duplicate_keys(child, ["k"]).collect()] == [(1, 2)]
    assert quality.duplicate_keys(child, ["k", "v"]).isEmpty()


def test_stored_keys(spark, child):
    stored = spark.createDataFrame([(2, "x"), (9, "y")], "k int, w string")
    assert [r.k for r in quality.stored_keys(child, stored, ["k"]).collect()] == [2]


def test_orphans_count_rows_and_skip_null(spark, child):
    parent = spark.createDataFrame([(2,)], "id int")
    with_null = child.unionByName(spark.createDataFrame([(None, "z")], child.schema))
    found = quality.orphans(with_null, parent, {"k": "id"}).collect()
    assert sorted(map(tuple, found)) == [(1, 2), (3, 1)]


def test_null_counts(child):
    assert {tuple(r) for r in quality.null_counts(child, ["k", "v"]).collect()} == {("k", 0), ("v", 1)}


def test_outside_domain_leaves_null_alone(child):
    assert [r.v for r in quality.outside_domain(child, "v", ["a", "b"]).collect()] == ["c"]


def test_require(child):
    quality.require_empty(child.limit(0), "nothing")
    with pytest.raises(ConstraintViolation, match="bad rows"):
        quality.require_empty(child, "bad rows")
    assert quality.require_not_null(child, ["k"], "child") == 4
    with pytest.raises(ConstraintViolation, match="NULL in {'v': 1}"):
        quality.require_not_null(child, ["k", "v"], "child")
    with pytest.raises(ValueError, match="need at least 5 rows"):
        quality.require_rows(child, 5, "do it")
    quality.require_rows(child, 4, "do it")


def test_require_label(child):
    with pytest.raises(ValueError, match="label must be"):
        quality.require_label(child, "label3", ("label1", "label2"))
    with pytest.raises(ValueError, match="missing"):
        quality.require_label(child, "label1", ("label1", "label2"))


def test_upsert_changes_only_the_replaced_column(spark):
    columns = "run_id string, dataset string, source_uri string"
    stored = spark.createDataFrame([("a", "D1", "s1"), ("b", None, "s2")], columns)
    incoming = spark.createDataFrame([("a", "D9", "s9"), ("b", "D8", None), ("c", "D3", "s3")], columns)
    out = catalogue.upsert(stored, incoming, "run_id", ["source_uri"])
    assert sorted(map(tuple, out.collect())) == [
        ("a", "D1", "s9"), ("b", None, None), ("c", "D3", "s3"),
    ]


def test_without(spark, child):
    left = catalogue.without(child, spark.createDataFrame([(1,)], "k int"), "k")
    assert sorted(r.k for r in left.collect()) == [2, 3]


def test_orphans_count_before_the_join(spark, child):
    parent = spark.createDataFrame([(2,)], "id int")
    plan = quality.orphans(child, parent, {"k": "id"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftAnti") < plan.index("Aggregate")


def test_a_key_is_checked_in_one_grouping(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "b")], "id int, cycle int, v string")
    key = ["id", "cycle"]
    assert quality.require_key(rows, key, "rows") == 3
    assert quality.require_key(rows.limit(0), key, "rows", ["v"]) == 0
    with pytest.raises(quality.ConstraintViolation, match="NULL in {'v': 1}"):
        quality.require_key(rows, key, "rows", ["v"])
    with pytest.raises(quality.ConstraintViolation, match="twice"):
        quality.require_key(rows.unionByName(rows), key, "rows")
    missing = spark.createDataFrame([(None, 1, "a"), (None, 1, "a")], "id int, cycle int, v string")
    with pytest.raises(quality.ConstraintViolation, match="NULL in {'id': 2}"):
        quality.require_key(rows.unionByName(missing), key, "rows")
