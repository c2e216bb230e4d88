"""Column names and table schemas.

The names, types and defaults below are fixed values: files, tables and stored
models of existing users depend on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw record is id, cycle, three settings, twenty-one sensors.
SETTINGS = tuple(f"setting{i}" for i in range(1, 4))
SENSORS = tuple(f"s{i}" for i in range(1, 22))
READING_COLUMNS = ("id", "cycle", *SETTINGS, *SENSORS)
KINDS = ("train", "test")
LABELS = ("label1", "label2")
NON_FEATURE_COLUMNS = frozenset(
    {"run_id", "id", "cycle", "rul", "label1", "label2", "operationmode"}
)

# Defaults of the feature table, the clustering and the classifiers.
WINDOW_ROWS = 5
WARN_AT = 30
ALARM_AT = 15
OP_MODES_K = 6
OP_MODES_RESTARTS = 10
SEED = 42


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_STRING, _INT, _DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()

RUNS = _struct(
    ("run_id", _STRING, False),
    ("dataset", _STRING, False),
    ("kind", _STRING, False),
    ("source_uri", _STRING, True),
    ("ingested_at", T.TimestampType(), False),
)

READINGS = _struct(
    ("run_id", _STRING, False),
    ("id", _INT, False),
    ("cycle", _INT, False),
    *((name, _DOUBLE, True) for name in (*SETTINGS, *SENSORS)),
)

TRUTH = _struct(
    ("run_id", _STRING, False),
    ("id", _INT, False),
    ("rul_at_maxcycle", _INT, False),
)

MODELS = _struct(
    ("model_id", _STRING, False),
    ("name", _STRING, False),
    ("algo", _STRING, False),
    ("params", _STRING, False),
    ("metrics", _STRING, False),
    ("classes", T.ArrayType(_INT), False),
    ("artifact_uri", _STRING, False),
    ("trained_on", _STRING, False),
    ("trained_at", T.TimestampType(), False),
)

PREDICTIONS = _struct(
    ("model_id", _STRING, False),
    ("run_id", _STRING, False),
    ("id", _INT, False),
    ("cycle", _INT, False),
    ("label_pred", _INT, False),
    ("proba", T.MapType(_STRING, _DOUBLE), True),
)
