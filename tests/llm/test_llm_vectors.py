"""Hard negatives and centroid clusters against brute force, on whole tables and on odd rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as contract
from wearline.llm import bond, centroid_tree

NAN, INF = float("nan"), float("inf")
CLASHING = "row string, anchor string, wanted string, shelf string, cluster string, distance string, pack string"


def on_grid(vector):
    return [math.floor(256 * x) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def negatives_by_hand(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    """rows: (vec_id, label, vector); what hard_negatives() returns, sorted."""
    there = [(i, c, on_grid(v)) for i, c, v in rows if i is not None and c is not None and usable(v)]
    out = []
    for a, (anchor_id, label, vector) in enumerate(there):
        if not is_anchor(anchor_id):
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, c, b) for b, (i, c, v) in enumerate(there)]
        scored.sort()
        for p, positive_id, *_ in [s for s in scored if s[2] == label and s[3] != a][:positives]:
            fitting = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p]
            for rank, (n, negative_id, *_) in enumerate(fitting[:negatives], 1):
                out.append((anchor_id, positive_id, rank, negative_id, -p, -n))
    return sorted(out)


def clusters_by_hand(rows, k, rounds, dims):
    """rows: (vec_id, vector); (vec_id, cluster, distance) sorted, and the final centroids."""
    there = [(i, on_grid(v)) for i, v in rows if usable(v) and len(v) == dims]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(there, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in there:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, vs in members.items():
            centroids[n] = [sum(column) // len(vs) for column in zip(*vs)]
    return sorted((i is None, i or 0, *nearest(v)[::-1]) for i, v in there), centroids


def odd_rows(dims):
    draw = np.random.default_rng(5)
    clouds = draw.normal(size=(4, dims))
    rows = []
    for i in range(120):
        rows.append((i, i % 3, (clouds[i % 4] + 0.3 * draw.normal(size=dims)).round(2).tolist()))
    same = clouds[0].round(2).tolist()
    rows += [(200 + i, i % 2, same) for i in range(40)]
    rows += [(0, 0, same), (0, 0, same), (300, 1, [0.0] * dims), (400, 1, [-x for x in same])]
    rows += [(None, 0, same), (500, None, same), (600, 0, None), (700, 1, [None] * dims), (800, 1, [NAN] * dims)]
    rows += [(900, 0, [INF, *same[1:]]), (1000, 0, []), (1100, 0, same[:-1]), (1200, 1, [*same, 1.0])]
    return rows


def frame(spark, rows):
    schema = f"vec_id long, label int, embedding array<double>, {CLASHING}"
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], schema)


def test_windows_are_exact():
    for score in range(-30, 300):
        low, high = bond.window(score, 80, 100)
        assert [s for s in range(-60, 320) if 80 * score <= 100 * s <= 100 * score] == list(range(low, high + 1))


@pytest.mark.parametrize("block, pack", [(8192, 256), (7, 3)])
def test_negatives_of_odd_rows(spark, monkeypatch, block, pack):
    monkeypatch.setattr(bond, "BLOCK_ROWS", block)
    monkeypatch.setattr(bond, "PACK_ANCHORS", pack)
    rows = odd_rows(12)
    found = bond.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    assert sorted(map(tuple, found.collect())) == negatives_by_hand(rows, lambda i: i % 10 == 0)


def test_negatives_of_other_sizes_and_bounds(spark):
    rows = [(i, i % 2, [math.sin(i * j) for j in range(1, 20)]) for i in range(80)]
    found = bond.hard_negatives(frame(spark, rows), F.col("vec_id") < 9, positives=2, negatives=3, bounds=(50, 150))
    wanted = negatives_by_hand(rows, lambda i: i < 9, 2, 3, 50, 150)
    assert sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in found.collect()) == wanted


def test_search_of_a_block_is_exact():
    draw = np.random.default_rng(1)
    matrix = draw.integers(-40, 40, size=(500, 30))
    block = bond.Block(np.arange(500), np.zeros(500, dtype=int), np.arange(500), matrix.T.astype(float))
    vector = draw.integers(-40, 40, size=30)
    scores = matrix @ vector
    looked = []

    def narrowed(least, most):
        looked.append(len(least))
        assert (least <= most).all()
        return most >= np.partition(least, -5)[-5] if len(least) >= 5 else np.ones(len(least), bool)

    found, exact = block.search(vector, np.arange(500), narrowed)
    assert (exact == scores[found]).all()
    assert set(np.argsort(-scores)[:5]) <= set(found)
    assert looked == sorted(looked, reverse=True) and looked[-1] < 500


def test_negatives_without_rows(spark):
    for rows in ([], [(None, None, None)], [(0, 1, [1.0])], [(0, 1, [1.0]), (100, 1, [1.0])]):
        assert bond.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0).collect() == []


def test_query_of_negatives_is_brute_force(spark):
    rows = []
    for r in spark.read.parquet(str(TESTDATA / "embeddings.parquet")).collect():
        label = (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label
        rows.append((r.vec_id, label, r.embedding))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = contract.queries()["op11_bond_negatives"](spark, str(TESTDATA))
    assert [t for _, t in found.select(*names).dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    found = sorted(map(tuple, found.select(*names).collect()))
    assert found == negatives_by_hand(rows, lambda i: i % 100 == 0)
    assert found


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_the_nearest_of_smallest_number(seed):
    draw = np.random.default_rng(seed)
    # Few values in few dimensions: most distances tie.
    centroids = draw.integers(-2, 3, size=(37, 2 + seed))
    points = draw.integers(-3, 4, size=(400, 2 + seed))
    number, distance = centroid_tree.Tree.over(centroids).nearest(points)
    every = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all()
    assert (distance == every.min(axis=1)).all()


def test_tree_of_large_numbers():
    top = 1 << 27
    centroids = np.array([[top] * 64, [-top] * 64, [top - 1] * 64, [0] * 64])
    number, distance = centroid_tree.Tree.over(centroids).nearest(np.array([[top] * 64, [-top] * 64, [top - 1] * 64]))
    assert number.tolist() == [0, 1, 2] and distance.tolist() == [0, 0, 0]
    _, distance = centroid_tree.Tree.over(centroids[1:2]).nearest(centroids[:1])
    assert distance.tolist() == [64 * (2 * top) ** 2]


@pytest.mark.parametrize("k, rounds", [(6, 3), (500, 2), (1, 1), (4, 0)])
def test_clusters_of_odd_rows(spark, k, rounds):
    rows = odd_rows(12)
    found, centroids = centroid_tree.clustered(frame(spark, rows), k=k, rounds=rounds, dims=12)
    wanted, of_hand = clusters_by_hand([(i, v) for i, _, v in rows], k, rounds, 12)
    assert sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found.collect()) == wanted
    assert centroids.tolist() == of_hand


def test_clusters_without_rows(spark):
    found, centroids = centroid_tree.clustered(frame(spark, [(1, 1, [1.0]), (2, 2, None)]))
    assert found.collect() == [] and len(centroids) == 0


def test_components_too_large(spark):
    with pytest.raises(Exception, match="must not exceed"):
        centroid_tree.clustered(frame(spark, [(1, 1, [1e300])]), dims=1)


def test_query_of_clusters_is_brute_force(spark):
    found = contract.queries()["op13_centroid_tree"](spark, str(TESTDATA)).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(str(TESTDATA / "embeddings.parquet")).collect()]
    wanted, centroids = clusters_by_hand(rows, 40, 5, 64)
    assert sorted((False, r.vec_id, r.cluster, r.distance) for r in found) == wanted
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    sums = {}
    for _, _, c, d in wanted:
        sums[c] = sums.get(c, 0) + d
    for r in found:
        assert (r.cluster_inertia, r.inertia) == (sums[r.cluster], sum(sums.values()))
        assert r.centroid_sha256 == digests[r.cluster]
