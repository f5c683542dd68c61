import pytest
from conftest import rows

from lakeloom import session


class Stub:
    """Just enough of a session to ask where its shared folder is."""

    def __init__(self, master, named=None, current=None):
        self.master, self.named, self.current = master, named, current
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def test_cluster_names_the_folder():
    assert session.shared_folder(Stub("yarn", named="hdfs:///shared")) == "hdfs:///shared"
    assert session.scratch_path(Stub("yarn", named="hdfs:///shared/"), "x").startswith("hdfs:///shared/lakeloom/x-")
    assert session.shared_folder(Stub("yarn", current="hdfs:///set")) == "hdfs:///set"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_folder(Stub("yarn"))
    assert session.shared_folder(Stub("local[2]")).startswith("/tmp/spark-")


def test_initial_partitions():
    assert session.initial_partitions(200, 8000) == 32000
    assert session.initial_partitions(50000, 8) == 50000


def test_settings_are_applied_to_a_given_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    assert session.tune(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_checkpoint_cuts_lineage(spark):
    kept = session.checkpointed(spark.range(5).selectExpr("id * 2 AS n"))
    assert rows(kept) == [(0,), (2,), (4,), (6,), (8,)]
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
