"""Centroid clustering on whole numbers, with a vantage-point tree over the centroids.

Each round the centroids are put into a vantage-point tree, which is broadcast (it holds ``k`` vectors, whatever the
table). A vector looks for its centroid best-first: of the nodes it has not opened, it opens the one with the smallest
possible distance, and stops when that exceeds the best distance found. The pruning radius is inclusive: a node whose smallest
possible distance equals the best one is opened, as it may hold a centroid of smaller number. Distances that decide are exact integers;
bounds, which come from square roots, are widened by more than their rounding error. Tasks add up the vectors of each cluster, so
that ``k`` sums per task are shuffled, and ``k`` sums reach the driver.

Vectors that are NULL, of another length, or with a NULL or infinite component or NaN are left out. Ties go to the centroid of smaller number. Equal
rows are clustered each; a NULL id counts as empty text in the choice of the first centroids. Fewer vectors than ``k`` make as many centroids. An empty
table gives no rows. Other columns are ignored. Components whose scaled value exceeds 2**27 raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import by_task, load, materialised, ready
from wearline.llm.vectors import as_matrix, on_grid, usable

LEAF = 3
FAR = np.iinfo(np.int64).max
# Of a bound made of two square roots of integers below 2**62.
ROUNDING = 1e-14


def squares(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors."""
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


@dataclass
class Node:
    """Centroids to compare with, and the children: number of the node, smallest and largest distance from the vantage point."""

    centroids: list[int]
    children: list[tuple[int, float, float]] = field(default_factory=list)


@dataclass
class Tree:
    """A vantage-point tree; the vantage point of an inner node is its only centroid."""

    centroids: np.ndarray
    nodes: list[Node]

    @classmethod
    def over(cls, centroids: np.ndarray) -> Tree:
        tree = cls(centroids, [])
        if len(centroids):
            tree._add(np.arange(len(centroids)))
        return tree

    def _add(self, members: np.ndarray) -> int:
        number = len(self.nodes)
        if len(members) <= LEAF:
            self.nodes.append(Node(members.tolist()))
            return number
        # The point farthest from the first member sees the others at the most different distances.
        vantage = int(np.argmax(squares(self.centroids[members], self.centroids[members[0]])))
        node = Node([int(members[vantage])])
        self.nodes.append(node)
        others = np.delete(members, vantage)
        distances = np.sqrt(squares(self.centroids[others], self.centroids[members[vantage]]).astype(np.float64))
        order = np.argsort(distances, kind="stable")
        for half in np.array_split(order, 2):
            child = self._add(others[half])
            node.children.append((child, float(distances[half].min()), float(distances[half].max())))
        return number

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row; all rows search side by side."""
        n = len(points)
        best, found = np.full(n, FAR), np.zeros(n, dtype=np.int64)
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, :1] = 0
        searching = np.arange(n)
        while len(searching):
            opened = bounds[searching].argmin(axis=1)
            least = bounds[searching, opened]
            on = (least <= np.sqrt(best[searching].astype(np.float64))) & np.isfinite(least)
            searching, opened, least = searching[on], opened[on], least[on]
            for number in np.unique(opened):
                here = opened == number
                rows = searching[here]
                node = self.nodes[number]
                bounds[rows, number] = np.inf
                own = points[rows]
                for c in node.centroids:
                    distance = squares(own, self.centroids[c])
                    better = (distance < best[rows]) | ((distance == best[rows]) & (c < found[rows]))
                    best[rows[better]], found[rows[better]] = distance[better], c
                if node.children:
                    away = np.sqrt(distance.astype(np.float64))
                    for child, nearest, farthest in node.children:
                        bound = np.maximum(nearest - away, away - farthest) - ROUNDING * (away + farthest)
                        bounds[rows, child] = np.maximum(bound, least[here])
        return found, best


def first_centroids(vectors: DataFrame, k: int, seed: str, scale: int, dims: int) -> np.ndarray:
    """The ``k`` vectors whose ids hash to the smallest values, in ascending order of the hash."""
    ident = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256).alias("digest")
    rows = vectors.select(digest, "embedding").orderBy("digest", "embedding").limit(k)
    column = rows.select("embedding").toArrow()["embedding"].combine_chunks()
    return as_matrix(*on_grid(column, scale), dims)


def cluster_sums(vectors: DataFrame, tree: Tree, scale: int, dims: int) -> dict[int, tuple[int, np.ndarray]]:
    """Per cluster that has vectors, how many and their sum."""
    sent = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        sums = np.zeros((len(tree.centroids), dims + 1), dtype=np.int64)
        for batch in batches:
            points = as_matrix(*on_grid(batch.column("embedding"), scale), dims)
            number, _ = tree.nearest(points)
            for c in np.unique(number):
                mine = points[number == c]
                sums[c, 0] += len(mine)
                sums[c, 1:] += mine.sum(axis=0)
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(cluster, pa.int32()), "place": pa.array(place, pa.int32()), "total": sums[cluster, place]}
        )

    parts = vectors.select("embedding").mapInArrow(by_task(run), "cluster int, place int, total long")
    out = np.zeros((len(tree.centroids), dims + 1), dtype=np.int64)
    # At most k * (dims + 1) rows.
    for cluster, place, total in parts.groupBy("cluster", "place").agg(F.sum("total")).collect():
        out[cluster, place] = total
    sent.destroy()
    return {c: (int(row[0]), row[1:]) for c, row in enumerate(out) if row[0]}


def assigned(vectors: DataFrame, tree: Tree, scale: int, dims: int) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    sent = vectors.sparkSession.sparkContext.broadcast(tree)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = sent.value.nearest(as_matrix(*on_grid(batch.column("embedding"), scale), dims))
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column("vec_id"), "cluster": pa.array(number, pa.int32()), "distance": distance}
            )

    return vectors.select("vec_id", "embedding").mapInArrow(by_task(run), f"vec_id {kind}, cluster int, distance long")


def clustered(
    vectors: DataFrame, *, k: int = 40, rounds: int = 5, seed: str = "2", dims: int = 64, scale: int = 256
) -> tuple[DataFrame, np.ndarray]:
    """Every usable row of ``vectors`` (vec_id, embedding) with its cluster, and the final centroids."""
    ready(vectors.sparkSession, times=8)
    vectors = vectors.where(usable(F.col("embedding"), dims)).select("vec_id", "embedding")
    centroids = first_centroids(vectors, k, seed, scale, dims)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for c, (count, total) in cluster_sums(vectors, Tree.over(centroids), scale, dims).items():
            moved[c] = total // count
        centroids = moved
    # Stored, so that distances are added up and returned without a second search.
    return materialised(assigned(vectors, Tree.over(centroids), scale, dims), "clusters"), centroids


def op13_centroid_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the whole table ``embeddings`` after five rounds."""
    rows, centroids = clustered(load(spark, sf_dir, "embeddings"))
    # One row per cluster, at most k.
    inertia = dict(rows.groupBy("cluster").agg(F.sum("distance")).collect())
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of_clusters = [(c, n, sum(inertia.values()), digests[c]) for c, n in inertia.items()]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(spark.createDataFrame(of_clusters, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
