"""Operating modes: clusters of the settings columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.operators.quality import require_rows
from wearline.schema import OP_MODES_K, OP_MODES_RESTARTS, SEED, SETTINGS
from wearline.session import stored

MAX_ITERATIONS = 300
# A fit ends once no centre moves further than this.
TOLERANCE = 1e-4
# Sums of the same numbers in another order agree to so many binary digits.
DIGITS = 40
MODE = "operationmode"
_WEIGHT, _HASH = "_weight", "_hash"


@dataclass(frozen=True)
class OpModeModel:
    """Fitted clusters; ``cost`` is the within-cluster sum of squares, None once reloaded."""

    spark: SparkSession
    settings: tuple[str, ...]
    centres: list[list[float]]
    cost: float | None = None

    def transform(self, readings: DataFrame) -> DataFrame:
        """``readings`` with the column ``operationmode``; no join, no shuffle."""
        return nearest_centre(readings, self.centres, settings=self.settings)

    def assign(self, readings: DataFrame, keys: Sequence[str] = ("id", "cycle")) -> DataFrame:
        """Table of ``keys`` and ``operationmode``."""
        return self.transform(readings.select(*keys, *self.settings)).select(*keys, MODE)

    def save(self, path: str) -> None:
        """A table of one row per mode."""
        rows = [(i, *c) for i, c in enumerate(self.centres)]
        columns = ", ".join(["operationmode long", *[f"`{s}` double" for s in self.settings]])
        self.spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OpModeModel:
        try:
            modes = spark.read.parquet(path)
        except Exception:
            modes = None
        if modes is None or modes.columns[:1] != [MODE]:
            raise TypeError(f"expected operating modes at {path}, got {_found(path)}")
        rows = sorted(modes.collect())
        return cls(spark, tuple(modes.columns[1:]), [list(r[1:]) for r in rows])


def _found(path: str) -> str:
    try:
        return type(PipelineModel.load(path).stages[-1]).__name__
    except Exception:
        return "something else"


def _mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Numbers above 0 and below 1 that the hashes and the salt alone determine."""
    with np.errstate(over="ignore"):
        x = hashes.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _points(batch: pa.RecordBatch, settings: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in settings])


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the closest centre, the lower on ties."""
    squares = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    modes = squares.argmin(axis=1)
    return modes, squares[np.arange(len(points)), modes]


def _seeds(points: DataFrame, settings: Sequence[str], k: int, seed: int, restarts: int) -> list[np.ndarray]:
    """First centres of all fits: each next one is drawn by weight and squared distance to those before.

    The draw is a race: every point runs for a time that its own hash and the seed determine, the faster the
    greater its weight, and the first wins. So one pass draws for all fits, and the draw
    does not depend on where the points lie.
    """
    chosen = [np.zeros((0, len(settings))) for _ in range(restarts)]
    for step in range(k):

        def run(batches: Iterator[pa.RecordBatch], step=step, chosen=tuple(chosen)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, weight = _points(batch, settings), batch.column(_WEIGHT).to_numpy()
                hashes = batch.column(_HASH).to_numpy()
                rows = []
                for fit, centres in enumerate(chosen):
                    mass = weight * _nearest(at, centres)[1] if step else weight
                    with np.errstate(divide="ignore"):
                        time = -np.log(_mixed(hashes, (seed + fit) * k + step)) / mass
                    first = int(np.lexsort((hashes, time))[0])
                    if np.isfinite(time[first]):
                        rows.append((fit, float(time[first]), at[first].tolist()))
                columns = list(zip(*rows, strict=True)) or [[], [], []]
                kinds = (pa.int32(), pa.float64(), pa.list_(pa.float64()))
                names = ("fit", "time", "at")
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)})

        drawn = points.mapInArrow(run, "fit int, time double, at array<double>")
        # One row per fit; fewer where all points are centres already.
        for fit, at in drawn.groupBy("fit").agg(F.min_by("at", F.struct("time", "at"))).collect():
            chosen[fit] = np.vstack([chosen[fit], at])
    return chosen


def _moved(points: DataFrame, settings: Sequence[str], centres: dict[int, np.ndarray]) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """Means of the points closest to each centre, and the cost, of all fits from one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {f: np.zeros((len(c), len(settings) + 2)) for f, c in centres.items()}
        for batch in batches:
            at, weight = _points(batch, settings), batch.column(_WEIGHT).to_numpy()
            for fit, of in centres.items():
                modes, squares = _nearest(at, of)
                for j, values in enumerate((weight, weight * squares, *(weight * at.T))):
                    sums[fit][:, j] += np.bincount(modes, weights=values, minlength=len(of))
        rows = [(f, m, s.tolist()) for f, of in sums.items() for m, s in enumerate(of)]
        fit, mode, total = zip(*rows, strict=True)
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()))
        columns = zip(("fit", "mode", "total"), (fit, mode, total), kinds, strict=True)
        yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in columns})

    parts = points.mapInArrow(run, "fit int, mode int, total array<double>")
    places = [F.sum(F.get("total", F.lit(j))) for j in range(len(settings) + 2)]
    moved, costs = {f: c.copy() for f, c in centres.items()}, dict.fromkeys(centres, 0.0)
    # At most ``k`` rows per fit.
    for fit, mode, weight, squares, *total in parts.groupBy("fit", "mode").agg(*places).collect():
        costs[fit] += squares
        if weight:
            moved[fit][mode] = _rounded(np.array(total) / weight)
    return moved, costs


def _rounded(values: np.ndarray) -> np.ndarray:
    """The same for sums that differ in the order of their parts only."""
    fraction, exponent = np.frexp(values)
    return np.ldexp(np.round(np.ldexp(fraction, DIGITS)), exponent - DIGITS)


def fit_op_modes(
    readings: DataFrame,
    *,
    k: int = OP_MODES_K,
    seed: int = SEED,
    restarts: int = OP_MODES_RESTARTS,
    settings: Sequence[str] = SETTINGS,
) -> OpModeModel:
    """Best of ``restarts`` k-means fits of the settings, which must not be NULL or NaN.

    Equal settings are first merged into one weighted point, which leaves the
    objective unchanged and keeps a setting shared by many rows from weighing
    on one task. All fits share each pass over the points. Fewer distinct points than ``k`` give fewer clusters.
    Modes are numbered in the order of their centres; the result does not depend on how the rows are spread.
    """
    require_rows(readings, k, f"fit {k} operating modes")
    numbers = [F.col(s).cast("double").alias(s) for s in settings]
    merged = readings.select(*numbers).groupBy(*settings).agg(F.count(F.lit(1)).cast("double").alias(_WEIGHT))
    with stored(merged.withColumn(_HASH, F.xxhash64(*settings)), "settings") as points:
        if not points.where(_unusable(settings)).isEmpty():
            raise ValueError(f"settings {list(settings)} have NULLs or NaNs")
        centres = dict(enumerate(_seeds(points, settings, k, seed, restarts)))
        costs: dict[int, float] = {}
        running = centres
        for _ in range(MAX_ITERATIONS):
            moved, found = _moved(points, settings, running)
            costs |= found
            still = [f for f, c in moved.items() if np.sqrt(((c - running[f]) ** 2).sum(axis=1)).max() > TOLERANCE]
            centres = {**centres, **moved}
            running = {f: centres[f] for f in still}
            if not running:
                break
        # Costs are those of the centres before the last move.
        _, costs = _moved(points, settings, centres)
    exact = {f: float(_rounded(np.array(c))) for f, c in costs.items()}
    best = min(exact, key=lambda f: (exact[f], f))
    return OpModeModel(readings.sparkSession, tuple(settings), sorted(centres[best].tolist()), exact[best])


def _unusable(settings: Sequence[str]) -> Column:
    bad = F.lit(False)
    for s in settings:
        bad = bad | F.col(s).isNull() | F.isnan(F.col(s).cast("double"))
    return bad


def nearest_centre(
    readings: DataFrame,
    centres: Sequence[Sequence[float]],
    *,
    settings: Sequence[str] = SETTINGS,
    name: str = MODE,
) -> DataFrame:
    """``readings`` with the index of the closest of the given centres, the lower on ties; no setting may be NULL or NaN."""
    distances = []
    for i, centre in enumerate(centres):
        squares = [
            (F.col(s) - F.lit(float(c))) * (F.col(s) - F.lit(float(c)))
            for s, c in zip(settings, centre, strict=True)
        ]
        distances.append(F.struct(sum(squares[1:], squares[0]).alias("d"), F.lit(i).cast("long").alias("i")))
    stop = F.raise_error(F.lit(f"settings {list(settings)} must not be NULL or NaN")).cast("long")
    return readings.withColumn(name, F.when(_unusable(settings), stop).otherwise(F.array_min(F.array(*distances))["i"]))
