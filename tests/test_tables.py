from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matrixmill.sources import tables


@pytest.fixture
def narrow(spark):
    return spark.createDataFrame([("a", 1.0)], "name string, count double")


@pytest.fixture
def other(spark):
    return spark.createDataFrame([("a", 1)], "name string, total int")


def test_roundtrip_and_overwrite(spark, rows, narrow, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(narrow, path)
    tables.write_table(narrow.selectExpr("upper(name) AS name", "count + 1 AS count"), path)
    assert rows(tables.read_table(spark, path)) == [("A", 2.0)]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_file_formats(spark, rows, narrow, tmp_path, fmt):
    path = str(tmp_path / "table")
    tables.write_table(narrow, path, fmt=fmt)
    assert rows(tables.read_table(spark, path, fmt), "name", "count") == [("a", 1.0)]


def test_changed_schema_is_refused_and_nothing_is_lost(spark, rows, narrow, other, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(narrow, path)
    with pytest.raises(tables.SchemaMismatchError, match="count.*total"):
        tables.write_table(other, path)
    assert rows(tables.read_table(spark, path)) == [("a", 1.0)]


def test_changed_type_is_refused(narrow, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(narrow, path)
    with pytest.raises(tables.SchemaMismatchError):
        tables.write_table(narrow.selectExpr("name", "CAST(count AS int) AS count"), path)


def test_schema_is_replaced_when_asked(spark, narrow, other, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(narrow, path)
    tables.write_table(other, path, overwrite_schema=True)
    assert tables.read_table(spark, path).columns == ["name", "total"]


@pytest.mark.parametrize("target", ["base/table", "base", "base/table/"])
def test_own_source_is_not_overwritten(spark, rows, narrow, tmp_path, target):
    path = str(tmp_path / "base" / "table")
    tables.write_table(narrow, path)
    source = tables.read_table(spark, path)
    for destination in (f"{tmp_path}/{target}", f"file://{tmp_path}/{target}"):
        with pytest.raises(ValueError, match="being read"):
            tables.write_table(source, destination)
    assert rows(tables.read_table(spark, path)) == [("a", 1.0)]


def test_neighbour_with_a_longer_name_is_no_source(spark, rows, narrow, tmp_path):
    tables.write_table(narrow, str(tmp_path / "table_old"))
    tables.write_table(narrow, str(tmp_path / "table"))
    tables.write_table(tables.read_table(spark, str(tmp_path / "table_old")), str(tmp_path / "table"))
    assert rows(tables.read_table(spark, str(tmp_path / "table"))) == [("a", 1.0)]


def test_staged_and_checkpointed_results_have_no_upstream(spark, rows, narrow):
    grouped = narrow.groupBy("name").count()
    for kept in (tables.staged(grouped, "counts"), tables.checkpointed(grouped)):
        assert rows(kept) == [("a", 1)]
        assert "Aggregate" not in kept._jdf.queryExecution().optimizedPlan().toString()


class _Cluster:
    """A session on a cluster, reduced to what the shared folder depends on."""

    def __init__(self, setting, master="yarn"):
        self.settings = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
        if setting:
            self.settings["spark.checkpoint.dir"] = setting
        self.set_to, self.master = None, master
        self.sparkContext = self.conf = self

    def get(self, key, *default):
        return self.settings.get(key, *default) if default else self.settings[key]

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, folder):
        self.set_to = folder


def test_cluster_folder_comes_from_the_setting():
    cluster = _Cluster("hdfs:///shared/checkpoints")
    assert tables.shared_folder(cluster) == "hdfs:///shared/checkpoints"
    assert cluster.set_to == "hdfs:///shared/checkpoints"
    assert tables.stage_path(cluster, "x").startswith("hdfs:///shared/checkpoints/staged/")


def test_without_the_setting_the_warehouse_holds_the_folder():
    for master in ("spark://host:7077", "local[2]", "local-cluster[2,1,1024]"):
        cluster = _Cluster(None, master)
        assert tables.shared_folder(cluster) == "hdfs:///warehouse/_intermediate"
        assert cluster.set_to == "hdfs:///warehouse/_intermediate"


def test_stage_paths_differ(spark):
    assert tables.stage_path(spark, "x") != tables.stage_path(spark, "x")


def test_a_local_folder_is_refused_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        for warehouse in ("file:/tmp/warehouse", "/tmp/warehouse", "spark-warehouse"):
            cluster = _Cluster(None, master)
            cluster.settings["spark.sql.warehouse.dir"] = warehouse
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                tables.shared_folder(cluster)
    for master in ("local", "local[4]", "local[*]"):
        cluster = _Cluster(None, master)
        cluster.settings["spark.sql.warehouse.dir"] = "file:/tmp/warehouse"
        assert tables.shared_folder(cluster) == "file:/tmp/warehouse/_intermediate"


def test_own_source_is_found_by_its_root(spark, tmp_path, monkeypatch):
    """Relative and absolute names of one folder are the same; similar names are not."""
    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", None)  # no file is listed
    base = str(tmp_path)
    tables.write_table(spark.range(3), f"{base}/a/table")
    stored = tables.read_table(spark, f"{base}/a/table")
    for target in (f"{base}/a/table", f"file:{base}/a/table/", f"{base}/a/./table", f"{base}/a", f"{base}/a/table/x"):
        with pytest.raises(ValueError, match="being read"):
            tables._refuse_own_source(stored, target)
    for target in ("table", "a/table", f"{base}/a/table2", f"{base}/b/a/table"):
        tables._refuse_own_source(stored, target)
    joined = stored.join(spark.range(2), "id").groupBy("id").count()
    with pytest.raises(ValueError, match="being read"):
        tables._refuse_own_source(joined, f"{base}/a/table")


def test_stored_frames_are_recognised(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.range(3).withColumn("x", F.lit(1.0)), path)
    stored = tables.read_table(spark, path)
    assert tables.is_stored(stored) and tables.is_stored(stored.select(F.col("x").alias("y"), "id"))
    assert tables.is_stored(tables.checkpointed(stored.groupBy("id").count()))
    assert tables.is_stored(spark.createDataFrame([(1,)], "a int"))
    assert not tables.is_stored(stored.groupBy("id").count())
    assert not tables.is_stored(stored.select(F.md5(F.col("id").cast("string"))))
    assert not tables.is_stored(stored.filter("id > 1").distinct())
