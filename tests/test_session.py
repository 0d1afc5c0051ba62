import pytest
from pyspark.sql import functions as F

from starlane.session import shared_folder, use_adaptive


class Session:
    """Just what ``shared_folder`` asks a session for."""

    def __init__(self, master, configured=None):
        self.master, self.configured, self.folder = master, configured, None
        self.conf = self.sparkContext = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_configured_folder_is_used():
    session = Session("yarn", "hdfs://shared/work/")
    assert shared_folder(session) == "hdfs://shared/work"
    assert session.folder is None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://host"))


def test_a_local_session_gets_one_folder():
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.folder


def test_a_small_file_of_many_rows_is_not_broadcast(spark, tmp_path):
    # 16 MB of rows, above the threshold of 10 MB; the file has less than 2 MB.
    rows = use_adaptive(spark).range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), F.lit(7).cast("long").alias("v"))
    rows.coalesce(1).write.parquet(str(tmp_path / "side"))
    side = spark.read.parquet(str(tmp_path / "side"))
    assert 1 << 20 < sum(f.stat().st_size for f in (tmp_path / "side").glob("*.parquet")) < 2 << 20
    plan = spark.range(10_000_000).join(side, F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_stored_rentals_are_joined_once(spark):
    from starlane.workload import tables

    sf = "/root/testdata/sf0.001"
    stored = tables.stored_rentals(spark, sf)
    assert not any("lineitem" in f for f in stored.inputFiles())
    assert stored.inputFiles() == tables.stored_rentals(spark, sf).inputFiles()
    assert sorted(map(str, stored.collect())) == sorted(map(str, tables.rentals(spark, sf).collect()))
