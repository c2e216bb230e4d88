from __future__ import annotations

import math
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wearline import schema  # noqa: E402
from wearline.session import configure  # noqa: E402
from wearline.sources.tables import Tables  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("wearline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


def synthetic_rows() -> list[tuple]:
    """Engine 1 with six cycles, engine 2 with three at ten times the values."""
    rows = []
    for engine, cycles, scale in ((1, 6, 1), (2, 3, 10)):
        for cycle in range(1, cycles + 1):
            sensors = [float(scale * (cycle + j - 1)) for j in range(1, 22)]
            rows.append((engine, cycle, 0.0, 0.0, 100.0, *sensors))
    return rows


def synthetic_text() -> str:
    return "".join(" ".join(f"{v:g}" for v in row) + " \n" for row in synthetic_rows())


@pytest.fixture
def synthetic_file(tmp_path):
    path = tmp_path / "synthetic.txt"
    path.write_text(synthetic_text())
    return str(path)


@pytest.fixture
def readings(spark):
    rows = [("SYN", *row) for row in synthetic_rows()]
    return spark.createDataFrame(rows, schema.READINGS)


def clouds_frame(per_class: int = 60) -> pd.DataFrame:
    """A feature table of three classes: engines that run cool, warm and hot, each a little off its level."""
    levels = {0: 20.0, 1: 50.0, 2: 95.0}
    columns = [*schema.SETTINGS, *[f"{p}{j}" for p in ("a", "sd") for j in range(1, 22)]]
    rows = []
    for place in range(3 * per_class):
        # Classes take turns, so that no slice of the table holds one alone.
        label = place % 3
        off = [math.sin(1 + place * 2.4 + j * 0.7) for j in range(21)]
        measured = [levels[label] + 2 * x for x in off]
        rows.append((place + 1, 1, 1.0, 2.0, 3.0, *measured, *[0.5] * 21, 10, int(label > 0), label))
    return pd.DataFrame(rows, columns=["id", "cycle", *columns, "rul", "label1", "label2"])


@pytest.fixture(scope="session")
def clouds(spark):
    return spark.createDataFrame(clouds_frame())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
