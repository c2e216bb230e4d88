from __future__ import annotations

import pytest

from wearline import session
from wearline.sources import jdbc


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert first != second and first.startswith(session.shared_folder(spark))


class _Cluster:
    class conf:  # noqa: N801
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:  # noqa: N801
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_Cluster)


def test_stored_copy_is_deleted(spark):
    df = spark.range(5).selectExpr("id", "id % 2 = 0 AS even")
    with session.stored(df, "copy", partition_by=["even"]) as copy:
        path = copy.inputFiles()[0]
        assert copy.columns == ["id", "even"]
        assert copy.where("even").count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_broadcast_only_below_the_bound(spark, monkeypatch):
    monkeypatch.setattr(session, "MAX_BROADCAST_ROWS", 10)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(session.broadcast_if_small(spark.range(10)))
    assert not hinted(session.broadcast_if_small(spark.range(11)))


def test_settings_are_applied(spark):
    assert all(spark.conf.get(key) == value for key, value in session.SETTINGS.items())


def test_database_reads_are_split_by_key(monkeypatch):
    calls = {}

    class Reader:
        def jdbc(self, url, table, **options):
            calls.update(url=url, table=table, **options)
            return "frame"

    class Spark:
        read = Reader()

    found = jdbc.read_table(Spark(), "jdbc:x", "readings", bounds=(1, 100), partitions=8)
    assert found == "frame"
    assert calls == {
        "url": "jdbc:x", "table": "readings", "column": "id", "lowerBound": 1, "upperBound": 100,
        "numPartitions": 8, "properties": {},
    }


def test_database_without_driver_says_so(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.write_table(spark.range(1), "jdbc:none://x/y", "t")


def test_methods_that_java_does_not_compile_are_cut(spark):
    """Java interprets methods above 8,000 bytes of code, which cleaning 66 columns in one generated loop is."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
