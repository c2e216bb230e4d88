"""Every operator as a query over the driver's tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LinearSVC
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.functions import min_max_scaled, nan_to_num, proba_columns, three_class_label
from wearline.operators import catalogue, metrics, quality
from wearline.operators.features import build_features, last_cycle
from wearline.operators.layout import ordinal
from wearline.operators.opmodes import fit_op_modes, nearest_centre
from wearline.operators.scoring import evaluate, score
from wearline.operators.split import HELD_OUT, stratified_split
from wearline.operators.training import (
    TrainResult,
    prepared,
    ranges,
    train_classifier,
    train_logistic_regression,
    train_random_forest,
)
from wearline.plans import jobs
from wearline.plans.panels import (
    EVENT_SENSORS,
    EVENT_SETTINGS,
    events_panel,
    orders_panel,
    orders_truth,
    runs_panel,
    sensor_lines,
    table,
    wide_panel,
    worn_panel,
)
from wearline.schema import SENSORS
from wearline.session import configure, scratch
from wearline.sources.registry import load_model, save_model
from wearline.sources.tables import Tables
from wearline.sources.text import read_sensor_text, read_truth_text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    """Register a query under its function name together with its SQL."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[run.__name__] = configured
        ORACLES[run.__name__] = oracle
        return run

    return register


# --- SQL pieces -------------------------------------------------------------------------

PANEL = """
panel AS (
  SELECT 'ev' AS run_id,
         user_id AS id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS cycle,
         CAST(hour(ts) AS DOUBLE) AS setting1,
         CAST(isodow(ts) AS DOUBLE) AS setting2,
         CAST(100 AS DOUBLE) AS setting3,
         value AS s1,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS s2,
         CAST((day(ts) - 1) * 24 + hour(ts) AS DOUBLE) AS s3,
         event_type
  FROM events)"""

TRUTH = """
truth AS (
  SELECT o_custkey AS id, CAST(count(*) AS INTEGER) AS rul_at_maxcycle
  FROM orders GROUP BY o_custkey)"""

LABEL_SQL = """CASE WHEN rul <= 30 THEN 1 ELSE 0 END AS label1,
         CASE WHEN rul <= 15 THEN 2 WHEN rul <= 30 THEN 1 ELSE 0 END AS label2"""


def _stats_sql(window: str, sensors: int = 3, onto: float = 0.5) -> str:
    return ", ".join(
        f"floor(avg(s{j}) OVER {window} * 1e6 + {onto}) / 1e6 AS a{j}, "
        f"floor(stddev_samp(s{j}) OVER {window} * 1e6 + {onto}) / 1e6 AS sd{j}"
        for j in range(1, sensors + 1)
    )


def _features_sql(
    *,
    frame: int = 5,
    source: str = "panel",
    ctes: str = PANEL,
    keys: str = "id",
    rul: str = "max(cycle) OVER (PARTITION BY {keys}) - cycle",
    joins: str = "",
    sensors: int = 3,
    extra: str = "",
    onto: float = 0.5,
) -> str:
    columns = ", ".join(["setting1", "setting2", "setting3", *[f"s{j}" for j in range(1, sensors + 1)]])
    return f"""
WITH {ctes},
rolled AS (
  SELECT {keys}, cycle, {columns}, {rul.format(keys=keys)} AS rul,
         {_stats_sql("w", sensors, onto)}{", event_type" if extra else ""}
  FROM {source} {joins}
  WINDOW w AS (PARTITION BY {keys} ORDER BY cycle ROWS BETWEEN {frame - 1} PRECEDING AND CURRENT ROW))
SELECT {keys}, cycle, {columns}, rul, {LABEL_SQL},
       {extra}{", ".join(f"a{j}, sd{j}" for j in range(1, sensors + 1))}
FROM rolled"""


def _rounded(features: DataFrame, sensors: int = 3, onto: float = 0.5) -> DataFrame:
    """Statistics at six places: the last digits depend on the order of summation.

    Means of more rows than ten can end in just half a place; for them ``onto`` is something else.
    """
    names = [f"{p}{j}" for j in range(1, sensors + 1) for p in ("a", "sd")]
    # Far cheaper than F.round, which goes through decimals.
    return features.withColumns({n: F.floor(F.col(n) * 1e6 + onto) / F.lit(1e6) for n in names})


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A derived panel as a plant keeps it: stored, so that passes over it do not derive it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _event_features(panel: DataFrame, kind: str = "train", **options) -> DataFrame:
    options = {"run_id": "ev", "settings": EVENT_SETTINGS, "sensors": EVENT_SENSORS, **options}
    return build_features(panel, kind, **options)


# --- the feature table ------------------------------------------------------------------


@query(_features_sql())
def features_train(spark, sf_dir):
    return _rounded(_event_features(events_panel(spark, sf_dir)))


@query(
    _features_sql(
        ctes=f"{PANEL}, {TRUTH}",
        joins="JOIN truth USING (id)",
        rul="(rul_at_maxcycle + max(cycle) OVER (PARTITION BY {keys})) - cycle",
    )
)
def features_test(spark, sf_dir):
    truth = orders_truth(spark, sf_dir)
    return _rounded(_event_features(events_panel(spark, sf_dir), "test", truth=truth))


@query(_features_sql(frame=10))
def features_window10(spark, sf_dir):
    return _rounded(_event_features(events_panel(spark, sf_dir), window_rows=10))


@query(_features_sql(frame=1))
def features_window1(spark, sf_dir):
    return _rounded(_event_features(events_panel(spark, sf_dir), window_rows=1))


@query(
    _features_sql(
        keys="run_id, id",
        ctes=f"{PANEL}, by_run AS (SELECT * REPLACE (event_type AS run_id) FROM panel)",
        source="by_run",
    )
)
def features_multi_run(spark, sf_dir):
    return _rounded(_event_features(runs_panel(spark, sf_dir), run_id=None))


_NULLED = f"""{PANEL}, nulled AS (
  SELECT * REPLACE (CASE WHEN event_type = 'purchase' THEN NULL ELSE s1 END AS s1) FROM panel)"""


def _nulled(spark, sf_dir):
    s1 = F.when(F.col("event_type") != "purchase", F.col("s1"))
    return events_panel(spark, sf_dir).withColumn("s1", s1)


@query(_features_sql(ctes=_NULLED, source="nulled"))
def features_null_sensor(spark, sf_dir):
    return _rounded(_event_features(_nulled(spark, sf_dir)))


@query(_features_sql(extra="CASE WHEN event_type <> 'view' THEN CAST(length(event_type) AS BIGINT) END AS operationmode, "))
def features_modes_left_join(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    modes = panel.where(F.col("event_type") != "view").select(
        "run_id", "id", "cycle", F.length("event_type").cast("long").alias("operationmode")
    )
    return _rounded(_event_features(panel, op_modes=modes))


_WIDE = f"""{PANEL}, wide AS (SELECT run_id, id, cycle, setting1, setting2, setting3,
  {", ".join(f"s1 + {j} * s2 AS s{j}" for j in range(1, 22))} FROM panel)"""


@query(_features_sql(sensors=21, ctes=_WIDE, source="wide"))
def features_21_sensors(spark, sf_dir):
    panel = wide_panel(spark, sf_dir)
    return _rounded(build_features(panel, "train", run_id="ev"), sensors=21)


@query(_features_sql())
def features_split_engines(spark, sf_dir):
    """``features_train`` with every engine of more than 20 cycles cut into blocks of 8."""
    panel = _kept(events_panel(spark, sf_dir, max_group_rows=20), "panel")
    return _rounded(_event_features(panel, max_group_rows=20, block_rows=8))


_TYPES = f"""{PANEL}, types AS (
  SELECT CAST(length(event_type) AS INTEGER) AS id,
         CAST(row_number() OVER (PARTITION BY length(event_type) ORDER BY ts, event_id) AS INTEGER) AS cycle,
         CAST(hour(ts) AS DOUBLE) AS setting1, CAST(isodow(ts) AS DOUBLE) AS setting2, CAST(100 AS DOUBLE) AS setting3,
         value AS s1, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS s2,
         CAST((day(ts) - 1) * 24 + hour(ts) AS DOUBLE) AS s3
  FROM events)"""


@query(_features_sql(frame=1000, ctes=_TYPES, source="types", onto=0.3))
def features_window1000(spark, sf_dir):
    """Frames of 1,000 rows over four engines, which are cut into blocks of at most 5,000 rows."""
    panel = _kept(events_panel(spark, sf_dir, engine=F.length("event_type"), max_group_rows=5000), "panel")
    return _rounded(_event_features(panel, window_rows=1000, max_group_rows=5000), onto=0.3)


@query(_features_sql(frame=40, onto=0.3))
def features_window40(spark, sf_dir):
    return _rounded(_event_features(events_panel(spark, sf_dir), window_rows=40), onto=0.3)


_COSTLY = """
truth AS (
  SELECT o_custkey AS id, CAST(count(*) AS INTEGER) AS rul_at_maxcycle
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)"""


@query(
    _features_sql(
        ctes=f"{PANEL}, {_COSTLY}",
        joins="JOIN truth USING (id)",
        rul="(rul_at_maxcycle + max(cycle) OVER (PARTITION BY {keys})) - cycle",
    )
)
def features_test_known_only(spark, sf_dir):
    """Engines without truth, those of customers without an urgent order, drop out."""
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    truth = orders_truth(spark, sf_dir, urgent)
    return _rounded(_event_features(events_panel(spark, sf_dir), "test", truth=truth))


@query(f"""
WITH {PANEL}
SELECT id, cycle, max(cycle) OVER (PARTITION BY id) - cycle AS rul,
       CAST(row_number() OVER (ORDER BY id, cycle) AS INTEGER) AS position
FROM panel""")
def features_ordered(spark, sf_dir):
    """Each row's place in an ordered feature table, numbered in the order in which it was written."""
    ordered = _event_features(events_panel(spark, sf_dir), ordered=True).select("id", "cycle", "rul")
    written = _kept(ordered.withColumns({"table": F.lit(0), "place": F.monotonically_increasing_id()}), "ordered")
    numbered = ordinal(written, ["table"], ["place"], "position", max_group_rows=5000)
    return numbered.select("id", "cycle", "rul", "position")


@query(
    _features_sql(
        ctes=f"{PANEL}, {TRUTH}",
        joins="JOIN truth USING (id)",
        rul="(rul_at_maxcycle + max(cycle) OVER (PARTITION BY {keys})) - cycle",
    )
)
def features_test_split_engines(spark, sf_dir):
    """``features_test`` with long engines cut into blocks."""
    truth = orders_truth(spark, sf_dir)
    panel = events_panel(spark, sf_dir)
    return _rounded(_event_features(panel, "test", truth=truth, max_group_rows=20, block_rows=8))


@query(f"WITH {PANEL} SELECT run_id, id, max(cycle) AS last_cycle FROM panel GROUP BY run_id, id")
def last_cycle_per_engine(spark, sf_dir):
    return last_cycle(events_panel(spark, sf_dir))


@query(
    f"""
WITH lives AS (
  SELECT o_custkey AS id, o_orderkey AS cycle, o_totalprice AS price,
         max(o_orderkey) OVER (PARTITION BY o_custkey) - o_orderkey AS rul,
         floor(avg(o_totalprice) OVER w * 1e6 + 0.5) / 1e6 AS a1,
         floor(stddev_samp(o_totalprice) OVER w * 1e6 + 0.5) / 1e6 AS sd1
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT id, cycle, price, rul, {LABEL_SQL}, a1, sd1 FROM lives"""
)
def rul_labels_orders(spark, sf_dir):
    panel = orders_panel(spark, sf_dir)
    table_ = build_features(panel, "train", run_id="orders", settings=[], sensors=["price"])
    return _rounded(table_, sensors=1)


@query(f"WITH {PANEL} SELECT event_type AS run_id, count(DISTINCT id) AS n_engines FROM panel GROUP BY event_type")
def entity_count(spark, sf_dir):
    return runs_panel(spark, sf_dir).groupBy("run_id").agg(F.count_distinct("id").alias("n_engines"))


@query(_features_sql())
def feature_table_roundtrip(spark, sf_dir):
    out = scratch(spark, "features")
    jobs.write_features(_event_features(events_panel(spark, sf_dir)), out)
    return _rounded(spark.read.parquet(out).orderBy("id", "cycle"))


# --- text files -------------------------------------------------------------------------

_TEXT_SQL = f"""
WITH {PANEL}
SELECT CAST(id AS INTEGER) AS id, cycle, setting1, setting2, setting3, s1, s2, s3, CAST(NULL AS DOUBLE) AS s4 FROM panel"""


def _through_text(spark, sf_dir, files="", **options):
    out = scratch(spark, "sensor-log")
    sensor_lines(events_panel(spark, sf_dir)).write.text(out, **options)
    return read_sensor_text(spark, out + files).select("id", "cycle", *EVENT_SETTINGS, *EVENT_SENSORS, "s4")


@query(f"""
WITH {_WIDE}
SELECT CAST(id AS INTEGER) AS id, cycle, setting1, setting2, setting3, {", ".join(SENSORS)} FROM wide""")
def sensor_text_roundtrip(spark, sf_dir):
    """All 26 columns of a log."""
    out = scratch(spark, "sensor-log")
    sensor_lines(wide_panel(spark, sf_dir), SENSORS).write.text(out)
    return read_sensor_text(spark, out)


@query(_TEXT_SQL)
def sensor_text_gzip(spark, sf_dir):
    return _through_text(spark, sf_dir, "/*.gz", compression="gzip")


@query(f"""
WITH {TRUTH}
SELECT CAST(row_number() OVER (ORDER BY truth.id) AS INTEGER) AS id, rul_at_maxcycle FROM truth""")
def truth_ordinal(spark, sf_dir):
    out = scratch(spark, "truth")
    in_order = orders_truth(spark, sf_dir).orderBy("id")
    in_order.select(F.col("rul_at_maxcycle").cast("string")).write.text(out)
    return read_truth_text(spark, out)


# --- constraints and catalogue ----------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def key_violations(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_linenumber = length(o_orderstatus))""")
def stored_key_overlap(spark, sf_dir):
    """Order lines whose number is that of the first line of a known order."""
    lines = table(spark, sf_dir, "lineitem")
    known = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.length("o_orderstatus").alias("l_linenumber")
    )
    return quality.stored_keys(lines, known, ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
GROUP BY o_custkey""")
def orphan_orders(spark, sf_dir):
    solvent = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return quality.orphans(table(spark, sf_dir, "orders"), solvent, {"o_custkey": "c_custkey"})


@query(f"""
WITH {_NULLED}, counted AS (
  SELECT count(*) - count(id) AS id, count(*) - count(cycle) AS cycle, count(*) - count(s1) AS s1 FROM nulled)
SELECT 'id' AS column_name, id AS n_null FROM counted
UNION ALL SELECT 'cycle', cycle FROM counted UNION ALL SELECT 's1', s1 FROM counted""")
def null_counts(spark, sf_dir):
    return quality.null_counts(_nulled(spark, sf_dir), ["id", "cycle", "s1"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def kind_check(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return quality.outside_domain(rows, "o_orderstatus", ["O", "F"])


@query("""
WITH stored AS (
  SELECT 'run-' || c_custkey AS run_id, c_mktsegment AS dataset, 'train' AS kind, c_name AS source_uri FROM customer),
incoming AS (
  SELECT 'run-' || (o_custkey + 7) AS run_id, max(o_orderpriority) AS dataset, 'test' AS kind,
         'orders-' || count(*) AS source_uri FROM orders GROUP BY o_custkey)
SELECT coalesce(s.run_id, i.run_id) AS run_id, coalesce(s.dataset, i.dataset) AS dataset,
       coalesce(s.kind, i.kind) AS kind, coalesce(i.source_uri, s.source_uri) AS source_uri
FROM stored s FULL JOIN incoming i ON s.run_id = i.run_id""")
def upsert_runs(spark, sf_dir):
    stored = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("run-"), F.col("c_custkey").cast("string")).alias("run_id"),
        F.col("c_mktsegment").alias("dataset"),
        F.lit("train").alias("kind"),
        F.col("c_name").alias("source_uri"),
    )
    # Numbered past the known customers, so that some runs are new.
    incoming = (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat(F.lit("run-"), (F.col("o_custkey") + 7).cast("string")).alias("run_id"))
        .agg(
            F.max("o_orderpriority").alias("dataset"),
            F.lit("test").alias("kind"),
            F.concat(F.lit("orders-"), F.count(F.lit(1)).cast("string")).alias("source_uri"),
        )
    )
    return catalogue.upsert(stored, incoming, "run_id", ["source_uri"])


def _deployed(spark, sf_dir) -> Tables:
    """The events panel as five runs of a deployment."""
    tables = Tables(spark, scratch(spark, "deployment"))
    panel = _kept(runs_panel(spark, sf_dir), "panel")
    missing = {s: F.lit(None).cast("double") for s in SENSORS if s not in EVENT_SENSORS}
    tables.append_readings(panel.withColumns({"id": F.col("id").cast("int"), **missing}))
    for (run_id,) in panel.select("run_id").distinct().collect():
        tables.upsert_run(run_id, "events", "train", f"events/{run_id}")
    return tables


@query(f"""
WITH {PANEL} SELECT event_type AS run_id, CAST(id AS INTEGER) AS id, cycle, s1 FROM panel
WHERE event_type NOT IN (SELECT event_type FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)""")
def delete_run(spark, sf_dir):
    """What readers of a deployment see once its largest run is deleted."""
    tables = _deployed(spark, sf_dir)
    sizes = tables.readings().groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    tables.delete_run(sizes.orderBy(F.desc("n"), "run_id").first()["run_id"])
    return tables.readings().select("run_id", "id", "cycle", "s1")


@query(f"""
WITH {PANEL}
SELECT event_type AS run_id, 'events' AS dataset, 'train' AS kind,
       CASE event_type WHEN 'view' THEN 'again' ELSE 'events/' || event_type END AS source_uri,
       count(*) AS n_rows, count(DISTINCT id) AS n_engines
FROM panel GROUP BY event_type""")
def runs_listed(spark, sf_dir):
    """The runs of a deployment; one was listed again from another source."""
    tables = _deployed(spark, sf_dir)
    tables.upsert_run("view", "other", "test", "again")
    rows = tables.readings().groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_engines")
    )
    return tables.runs().drop("ingested_at").join(rows, "run_id")


@query(f"""
WITH {PANEL} SELECT event_type AS run_id, id, cycle, s1 FROM panel
WHERE event_type NOT IN (SELECT event_type FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)""")
def rows_without_largest_run(spark, sf_dir):
    """All runs but the largest."""
    panel = runs_panel(spark, sf_dir)
    sizes = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run_id")).count()
    largest = sizes.orderBy(F.desc("count"), "run_id").limit(1)
    return catalogue.without(panel, largest, "run_id").select("run_id", "id", "cycle", "s1")


@query(f"""
WITH {PANEL}
SELECT 'm1' AS model_id, event_type AS run_id, CAST(id AS INTEGER) AS id, cycle,
       CAST(CASE WHEN event_type IN ('click', 'view') THEN length(event_type) ELSE 0 END AS INTEGER) AS label_pred,
       round(s2 / 100, 6) AS p0, round(1 - s2 / 100, 6) AS p1
FROM panel WHERE event_type <> 'error'""")
def replace_predictions(spark, sf_dir):
    """Every run written, two of them twice with new labels, one replaced by nothing."""
    tables = Tables(spark, scratch(spark, "predictions"))
    rows = runs_panel(spark, sf_dir).select(
        "run_id",
        F.col("id").cast("int").alias("id"),
        "cycle",
        F.length("event_type").cast("int").alias("label_pred"),
        F.create_map(F.lit("0"), F.col("s2") / 100, F.lit("1"), 1 - F.col("s2") / 100).alias("proba"),
    )
    for run_id in ("click", "error", "purchase", "signup", "view"):
        first = rows.where(F.col("run_id") == run_id).withColumn("label_pred", F.lit(0))
        tables.replace_predictions(first, "m1", run_id)
    for run_id in ("click", "view"):
        tables.replace_predictions(rows.where(F.col("run_id") == run_id), "m1", run_id)
    tables.replace_predictions(rows.limit(0), "m1", "error")
    return tables.predictions("m1").select(
        "model_id",
        "run_id",
        "id",
        "cycle",
        "label_pred",
        F.round(F.col("proba")["0"], 6).alias("p0"),
        F.round(F.col("proba")["1"], 6).alias("p1"),
    )


# --- metrics ----------------------------------------------------------------------------

_CELLS = """
pairs AS (SELECT quality AS y_true, toxic AS y_pred FROM labels),
names AS (SELECT DISTINCT y_true AS label FROM pairs UNION SELECT DISTINCT y_pred FROM pairs),
cells AS (
  SELECT t.label AS y_true, p.label AS y_pred,
         (SELECT count(*) FROM pairs WHERE pairs.y_true = t.label AND pairs.y_pred = p.label) AS n
  FROM names t, names p),
counted AS (
  SELECT label,
         (SELECT sum(n) FROM cells WHERE y_true = label AND y_pred = label) AS tp,
         (SELECT sum(n) FROM cells WHERE y_true = label) AS support,
         (SELECT sum(n) FROM cells WHERE y_pred = label) AS predicted
  FROM names),
rates AS (
  SELECT label,
         CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1,
         CAST(support AS BIGINT) AS support, tp
  FROM counted)"""


def _label_pairs(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred")
    )


@query(f"WITH {_CELLS} SELECT y_true, y_pred, n FROM cells")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_cells(_label_pairs(spark, sf_dir))


@query(f"""
WITH {_CELLS} SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support
FROM rates""")
def metrics_per_label(spark, sf_dir):
    rows = metrics.per_label(_label_pairs(spark, sf_dir))
    return rows.withColumns({m: F.round(m, 9) for m in ("precision", "recall", "f1")})


@query(f"""
WITH {_CELLS}, matrix AS (
  SELECT string_agg(line, ',' ORDER BY y_true) AS lines
  FROM (SELECT y_true, '[' || string_agg(n::VARCHAR, ',' ORDER BY y_pred) || ']' AS line FROM cells GROUP BY y_true))
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 9) AS accuracy,
       round(sum(precision * support) / sum(support), 9) AS weighted_precision,
       round(sum(recall * support) / sum(support), 9) AS weighted_recall,
       round(sum(f1 * support) / sum(support), 9) AS weighted_f1,
       '[' || any_value(lines) || ']' AS confusion_matrix
FROM rates, matrix""")
def metrics_summary(spark, sf_dir):
    rates = ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")
    return metrics.summarize(_label_pairs(spark, sf_dir)).select(
        "n",
        *[F.round(m, 9).alias(m) for m in rates],
        F.to_json("confusion_matrix").alias("confusion_matrix"),
    )


@query(f"""
WITH {PANEL},
labelled AS (SELECT event_type AS run_id,
         CASE WHEN rul <= 15 THEN 2 WHEN rul <= 30 THEN 1 ELSE 0 END AS y_true,
         CASE WHEN s3 >= 540 THEN 2 WHEN s3 >= 360 THEN 1 ELSE 0 END AS y_pred
  FROM (SELECT *, max(cycle) OVER (PARTITION BY id) - cycle AS rul FROM panel)),
names AS (SELECT run_id, y_true AS label FROM labelled UNION SELECT run_id, y_pred FROM labelled),
counted AS (
  SELECT names.run_id, label,
         count(*) FILTER (y_true = label AND y_pred = label) AS tp,
         count(*) FILTER (y_true = label) AS support,
         count(*) FILTER (y_pred = label) AS predicted
  FROM names JOIN labelled ON names.run_id = labelled.run_id GROUP BY names.run_id, label)
SELECT run_id, CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 9) AS accuracy,
       round(sum(CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END * support) / sum(support), 9) AS weighted_precision,
       round(sum(CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END * support) / sum(support), 9) AS weighted_f1
FROM counted GROUP BY run_id""")
def metrics_by_run(spark, sf_dir):
    """A time-of-month rule judged against the three-class label, per run."""
    panel = events_panel(spark, sf_dir)
    types = panel.select("run_id", "id", "cycle", "event_type")
    modes = types.withColumnRenamed("event_type", "operationmode")
    labelled = _event_features(panel, op_modes=modes)
    guessed = three_class_label(F.lit(720) - F.col("s3"), warn_at=360, alarm_at=180)
    pairs = labelled.select(
        F.col("operationmode").alias("run_id"), F.col("label2").alias("y_true"), guessed.alias("y_pred")
    )
    rates = ("accuracy", "weighted_precision", "weighted_f1")
    return metrics.summarize(pairs, by=["run_id"]).select(
        "run_id", "n", *[F.round(m, 9).alias(m) for m in rates]
    )


# --- preparation of features ------------------------------------------------------------


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 0 WHEN 'click' THEN 1.7976931348623157E308
  WHEN 'error' THEN -1.7976931348623157E308 ELSE value END AS x FROM events""")
def clean_values(spark, sf_dir):
    kind = F.col("event_type")
    broken = (
        F.when(kind == "view", float("nan"))
        .when(kind == "click", float("inf"))
        .when(kind == "error", -float("inf"))
        .when(kind == "signup", None)
        .otherwise(F.col("value"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", broken.alias("x"))
    return rows.select("event_id", nan_to_num("x").alias("x"))


@query(f"""
WITH {PANEL}, bounds AS (SELECT min(s1) AS l1, max(s1) AS h1, min(s2) AS l2, max(s2) AS h2 FROM panel)
SELECT id, cycle, round((s1 - l1) / (h1 - l1), 6) AS s1, round((s2 - l2) / (h2 - l2), 6) AS s2,
       CAST(0 AS DOUBLE) AS setting3
FROM panel, bounds""")
def min_max_scale(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    bounds = ranges(panel, ["s1", "s2", "setting3"])
    scaled = [F.round(min_max_scaled(c, *bounds[c]), 6).alias(c) for c in bounds]
    return panel.select("id", "cycle", *scaled)


@query(f"""
WITH {PANEL},
labelled AS (
  SELECT id, cycle, CASE WHEN rul <= 15 THEN 2 WHEN rul <= 30 THEN 1 ELSE 0 END AS label2
  FROM (SELECT *, max(cycle) OVER (PARTITION BY id) - cycle AS rul FROM panel)),
counts AS (SELECT label2, count(*) AS n FROM labelled GROUP BY label2),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS BIGINT) AS held FROM counts),
parts AS (
  SELECT label2, total.held * counts.n // total.n AS base, total.held * counts.n % total.n AS rest, total.held AS held
  FROM counts, total),
quotas AS (
  SELECT label2, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label2) <= held - sum(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM parts),
placed AS (
  SELECT id, cycle, label2, row_number() OVER (PARTITION BY label2
           ORDER BY md5('42:' || id || ':' || cycle), id, cycle) AS place
  FROM labelled)
SELECT id, cycle, label2, place <= quota AS held_out FROM placed JOIN quotas USING (label2)""")
def stratified_hold_out(spark, sf_dir):
    out = scratch(spark, "labels")
    labelled = _event_features(events_panel(spark, sf_dir)).select("id", "cycle", "label2")
    jobs.write_features(labelled, out)
    rows = spark.read.parquet(out)
    return stratified_split(rows, "label2", ["id", "cycle"], 0.2, 42).select(
        "id", "cycle", "label2", HELD_OUT
    )


# --- operating modes --------------------------------------------------------------------

CENTRES = [(3.0, 2.0, 100.0), (9.0, 6.0, 100.0), (15.0, 2.0, 100.0), (21.0, 6.0, 100.0)]


@query(f"""
WITH {PANEL}, far AS (
  SELECT id, cycle, unnest([{", ".join(f"{{'d': (setting1-{a})*(setting1-{a})+(setting2-{b})*(setting2-{b})+(setting3-{c})*(setting3-{c}), 'i': {i}}}" for i, (a, b, c) in enumerate(CENTRES))}]) AS x
  FROM panel)
SELECT id, cycle, CAST(min(x).i AS BIGINT) AS operationmode FROM far GROUP BY id, cycle""")
def modes_of_fixed_centres(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    return nearest_centre(panel, CENTRES).select("id", "cycle", "operationmode")


def _flag_settings(spark, sf_dir):
    """Order lines as points near one corner per return flag and line status."""
    flag = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 10.0).otherwise(20.0)
    status = F.when(F.col("l_linestatus") == "F", 0.0).otherwise(10.0)
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        (flag + F.col("l_discount")).alias("setting1"),
        (status + F.col("l_tax")).alias("setting2"),
        F.lit(100.0).alias("setting3"),
    )


@query("""
WITH points AS (
  SELECT l_returnflag, l_linestatus,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 10 ELSE 20 END + CAST(l_discount AS DOUBLE) AS x,
         CASE l_linestatus WHEN 'F' THEN 0 ELSE 10 END + CAST(l_tax AS DOUBLE) AS y
  FROM lineitem),
corners AS (
  SELECT l_returnflag, l_linestatus, count(*) AS n_rows, avg(x) AS x, avg(y) AS y,
         var_pop(x) * count(*) + var_pop(y) * count(*) AS squares
  FROM points GROUP BY l_returnflag, l_linestatus)
SELECT l_returnflag, l_linestatus, n_rows, CAST(1 AS BIGINT) AS n_modes, CAST(1 AS BIGINT) AS n_corners_of_mode,
       floor(x * 1e6 + 0.3) / 1e6 AS centre1, floor(y * 1e6 + 0.3) / 1e6 AS centre2, CAST(100 AS DOUBLE) AS centre3,
       floor(sum(squares) OVER () * 1e4 + 0.3) / 1e4 AS cost
FROM corners""")
def modes_fitted(spark, sf_dir):
    """Modes fitted to clouds of points: each cloud gets one mode, its centre is the cloud's mean, and the cost is what is left."""
    rows = _flag_settings(spark, sf_dir)
    corner = ["l_returnflag", "l_linestatus"]
    model = fit_op_modes(rows)
    counts = model.transform(rows).groupBy(*corner, "operationmode").agg(F.count(F.lit(1)).alias("n"))
    shared = counts.groupBy("operationmode").agg(F.count(F.lit(1)).alias("n_corners"))
    found = (
        counts.join(shared, "operationmode")
        .groupBy(*corner)
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_modes"),
            F.max("n_corners").alias("n_corners_of_mode"),
            F.max_by("operationmode", "n").alias("mode"),
        )
    )
    centre = F.get(F.array(*[F.array(*map(F.lit, c)) for c in model.centres]), F.col("mode").cast("int"))
    found = found.withColumns({f"centre{j + 1}": F.floor(F.get(centre, F.lit(j)) * 1e6 + 0.3) / 1e6 for j in range(3)})
    return found.drop("mode").withColumn("cost", F.floor(F.lit(model.cost) * 1e4 + 0.3) / 1e4)


# --- models -----------------------------------------------------------------------------

_LABELLED = f"""{PANEL},
labelled AS (
  SELECT id, cycle, CASE WHEN rul <= 15 THEN 2 WHEN rul <= 30 THEN 1 ELSE 0 END AS label2
  FROM (SELECT *, max(cycle) OVER (PARTITION BY id) - cycle AS rul FROM panel))"""


def _stored_features(spark, sf_dir) -> DataFrame:
    """The feature table of all 24 measured columns (66 features), as a job stores it."""
    out = scratch(spark, "features")
    jobs.write_features(build_features(worn_panel(spark, sf_dir), "train", run_id="ev"), out)
    return spark.read.parquet(out)


_TRAINED = f"""
WITH {_LABELLED}, total AS (SELECT count(*) AS n, count(DISTINCT label2) AS n_classes FROM labelled)
SELECT n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS n_train, CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS n_val,
       n_classes, TRUE AS beats_largest_class, TRUE AS counts_add_up
FROM total"""


def _training_report(spark, result: TrainResult) -> DataFrame:
    """Sizes of a training run and whether the hold-out shows it learned something."""
    val = result.val_metrics
    largest = max(m["support"] for m in val["per_label"].values()) / val["n"]
    row = (
        result.n_train,
        result.n_val,
        len(result.model.classes),
        val["accuracy"] > largest + 0.1,
        result.train_metrics["n"] == result.n_train and val["n"] == result.n_val,
    )
    return spark.createDataFrame(
        [row],
        "n_train long, n_val long, n_classes long, beats_largest_class boolean, counts_add_up boolean",
    )


@query(_TRAINED)
def train_rf(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    result = train_random_forest(features, val_fraction=0.2)
    return _training_report(spark, result)


@query(_TRAINED)
def train_lr(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    return _training_report(spark, train_logistic_regression(features, val_fraction=0.2))


@query(f"""
WITH {_LABELLED}
SELECT id, cycle::BIGINT AS cycle, label2::BIGINT AS y_true, TRUE AS sums_to_one, TRUE AS keys_are_classes,
       TRUE AS most_probable, TRUE AS wide_agrees
FROM labelled""")
def predict_invariants(spark, sf_dir):
    """Scores of every row, and what must hold for each."""
    features = _stored_features(spark, sf_dir)
    model = train_logistic_regression(features).model
    scored = score(model, features)
    wide = [p.alias(f"w{i}") for i, p in enumerate(proba_columns("proba", model.classes))]
    p = F.map_values("proba")
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
    names = F.array(*[F.lit(str(c)) for c in model.classes])
    return scored.select("*", *wide).select(
        "id",
        "cycle",
        "y_true",
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
        (F.map_keys("proba") == names).alias("keys_are_classes"),
        (F.col("proba")[F.col("label_pred").cast("string")] == F.array_max(p)).alias("most_probable"),
        (F.array(*[f"w{i}" for i in range(len(wide))]) == p).alias("wide_agrees"),
    )


@query(f"""
WITH {_LABELLED} SELECT id, cycle::BIGINT AS cycle, TRUE AS same_label, TRUE AS same_proba FROM labelled""")
def registry_roundtrip(spark, sf_dir):
    """A registered model, loaded again, scores every row as before."""
    tables = Tables(spark, scratch(spark, "registry"))
    tables.upsert_run("ev", "events", "train", "events")
    features = _stored_features(spark, sf_dir)
    result = train_random_forest(features)
    model_id = save_model(
        tables,
        result.model,
        name="rf",
        algo="random_forest",
        params={"n_estimators": 100, "max_depth": 10, "label": "label2"},
        metrics=result.metrics,
        trained_on="ev",
    )
    loaded = load_model(tables, model_id).model
    before = score(result.model, features).select(
        "id", "cycle", F.col("label_pred").alias("label_before"), F.map_values("proba").alias("p_before")
    )
    return (
        score(loaded, features)
        .join(before, ["id", "cycle"])
        .select(
            "id",
            "cycle",
            (F.col("label_pred") == F.col("label_before")).alias("same_label"),
            (F.map_values("proba") == F.col("p_before")).alias("same_proba"),
        )
    )


@query(f"""
WITH {_LABELLED} SELECT label2 AS label, count(*) AS support, TRUE AS accuracy_agrees FROM labelled GROUP BY label2""")
def evaluate_model(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    model = train_random_forest(features).model
    summary = evaluate(model, features)
    direct = score(model, features).agg(
        F.avg((F.col("y_true") == F.col("label_pred")).cast("double")).alias("direct")
    )
    rows = summary.select("accuracy", F.explode("per_label").alias("label", "m"))
    # Both sides are one row per model.
    accuracy = direct.first()["direct"]
    return rows.select(
        F.col("label").cast("int").alias("label"),
        F.col("m.support").alias("support"),
        (F.abs(F.col("accuracy") - accuracy) < 1e-9).alias("accuracy_agrees"),
    )


@query(f"""
WITH {PANEL}, {TRUTH}, n AS (SELECT count(*) AS n FROM panel),
tested AS (SELECT count(*) AS n FROM panel WHERE id + 1 IN (SELECT row_number() OVER (ORDER BY id) FROM truth))
SELECT 'readings' AS stage, n FROM n
UNION ALL SELECT 'truth', (SELECT count(*) FROM truth)
UNION ALL SELECT 'features', n FROM n
UNION ALL SELECT 'test features', n FROM tested
UNION ALL SELECT 'evaluated', n FROM n
UNION ALL SELECT 'predicted', n FROM n
UNION ALL SELECT 'predicted again', n FROM n""")
def jobs_end_to_end(spark, sf_dir):
    """All jobs from text files to stored predictions; rows handled per stage."""
    root = scratch(spark, "deployment")
    tables = Tables(spark, f"{root}/tables")
    # Engine numbers start at 1 in files, as truth files number their lines.
    panel = events_panel(spark, sf_dir).withColumn("id", F.col("id") + 1)
    sensor_lines(panel).write.text(f"{root}/log")
    truth = orders_truth(spark, sf_dir).orderBy("id")
    truth.select(F.col("rul_at_maxcycle").cast("string")).write.text(f"{root}/rul")

    n = {}
    n["readings"] = jobs.ingest_readings(
        spark, tables, run_id="ev", dataset="events", kind="train", path=f"{root}/log"
    )
    n["truth"] = jobs.ingest_truth(spark, tables, run_id="ev", path=f"{root}/rul")
    jobs.train_op_modes(tables, run_id="ev", out=f"{root}/modes")
    n["features"], _ = jobs.features(
        tables, run_id="ev", kind="train", out=f"{root}/features", op_modes_model=f"{root}/modes"
    )
    n["test features"], _ = jobs.features(tables, run_id="ev", kind="test", out=f"{root}/test")
    trained = jobs.train_lr(
        tables, features=f"{root}/features", out=f"{root}/lr", register=True, trained_on="ev"
    )
    where = {"model_id": trained.model_id, "features": f"{root}/features"}
    n["evaluated"] = jobs.evaluate_model(tables, **where, out=f"{root}/metrics.json")["n"]
    n["predicted"] = jobs.predict(tables, **where, run_id="ev", out=f"{root}/scores").n_written
    n["predicted again"] = jobs.predict(tables, **where, run_id="ev").n_written
    return spark.createDataFrame(list(n.items()), "stage string, n long")


@query(f"""
WITH {PANEL}, n AS (SELECT count(*) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS held FROM panel)
SELECT 'trained' AS stage, n - held AS n FROM n UNION ALL SELECT 'held out', held FROM n
UNION ALL SELECT 'saved metrics, train', n - held FROM n UNION ALL SELECT 'saved metrics, val', held FROM n
UNION ALL SELECT 'written evaluation', n FROM n UNION ALL SELECT 'predicted', n FROM n
UNION ALL SELECT 'wide rows that agree', n FROM n UNION ALL SELECT 'right as evaluated', 1 FROM n""")
def jobs_random_forest(spark, sf_dir):
    """Train, evaluate and predict jobs of a random forest, by what they left in files and tables."""
    root = scratch(spark, "forest")
    tables = Tables(spark, f"{root}/tables")
    tables.upsert_run("ev", "events", "train", "events")
    features = _stored_features(spark, sf_dir).inputFiles()[0].rpartition("/")[0]
    job = jobs.train_rf(tables, features=features, out=f"{root}/rf", register=True, trained_on="ev")
    where = {"model_id": job.model_id, "features": features}
    jobs.evaluate_model(tables, **where, out=f"{root}/metrics.json")
    written = jobs.predict(tables, **where, run_id="ev", out=f"{root}/wide").n_written
    saved = spark.read.json(f"{root}/rf.metrics.json", multiLine=True).first()
    summary = spark.read.json(f"{root}/metrics.json", multiLine=True).first()
    stored = tables.predictions(str(job.model_id), "ev").join(spark.read.parquet(f"{root}/wide"), ["id", "cycle", "label_pred"])
    classes = job.result.model.classes
    same = [F.col(f"proba_{c}") == F.col("proba")[str(c)] for c in classes]
    agree = stored.where(F.array_min(F.array(*[s.cast("int") for s in same])) == 1).count()
    truth = spark.read.parquet(features).select("id", "cycle", "label2")
    right = tables.predictions(str(job.model_id), "ev").join(truth, ["id", "cycle"])
    accuracy = right.agg(F.avg((F.col("label_pred") == F.col("label2")).cast("double"))).first()[0]
    rows = {
        "trained": job.result.n_train,
        "held out": job.result.n_val,
        "saved metrics, train": saved.train.n,
        "saved metrics, val": saved.val.n,
        "written evaluation": summary.n,
        "predicted": written,
        "wide rows that agree": agree,
        "right as evaluated": int(abs(accuracy - summary.accuracy) < 1e-9),
    }
    return spark.createDataFrame(list(rows.items()), "stage string, n long")


@query(f"""
WITH {PANEL}
SELECT event_type AS run_id, CAST(id AS INTEGER) AS id, cycle, TRUE AS known_label, TRUE AS sums_to_one FROM panel""")
def predict_several_runs(spark, sf_dir):
    """Stored predictions of five runs, scored at once."""
    tables = Tables(spark, scratch(spark, "runs"))
    panel = _kept(runs_panel(spark, sf_dir), "panel")
    for (run_id,) in panel.select("run_id").distinct().collect():
        tables.upsert_run(run_id, "events", "train", None)
    features = scratch(spark, "features")
    _event_features(panel, run_id=None).write.parquet(features)
    job = jobs.train_lr(tables, features=features, register=True, trained_on="view")
    jobs.predict(tables, model_id=job.model_id, features=features, run_id=None)
    total = F.aggregate(F.map_values("proba"), F.lit(0.0), lambda s, x: s + x)
    return tables.predictions(str(job.model_id)).select(
        "run_id",
        "id",
        "cycle",
        F.col("label_pred").isin(list(job.result.model.classes)).alias("known_label"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
    )


@query(f"""
WITH {_LABELLED}
SELECT id, cycle::BIGINT AS cycle, CASE WHEN label2 > 0 THEN 1 ELSE 0 END::BIGINT AS y_true,
       TRUE AS no_proba, TRUE AS known_label
FROM labelled""")
def predict_without_probabilities(spark, sf_dir):
    """Scores of a classifier that has no probabilities: they are NULL."""
    features = _stored_features(spark, sf_dir)
    model = train_classifier(features, prepared(LinearSVC(maxIter=50)), label="label1").model
    return score(model, features, label="label1").select(
        "id", "cycle", "y_true", F.col("proba").isNull().alias("no_proba"), F.col("label_pred").isin(0, 1).alias("known_label")
    )
