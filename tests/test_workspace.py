import pytest

from statlake.errors import LakeError
from statlake.operators.layout import spread
from statlake.plans.workspace import scratch_root


class _Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext = _Context(master)
        self.conf = conf


def test_shared_folder_comes_from_the_session():
    session = _Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_root(session).startswith("hdfs:///shared/statlake-app-1-")
    assert scratch_root(session) != scratch_root(session)


def test_cluster_needs_a_shared_folder():
    with pytest.raises(LakeError, match="spark.checkpoint.dir"):
        scratch_root(_Session("yarn"))


def test_local_session_may_do_without():
    assert "statlake-" in scratch_root(_Session("local[2]"))


def test_spread(spark, tmp_path):
    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "one"))
    spark.range(0, 1000, 1, 4).write.parquet(str(tmp_path / "four"))
    assert spread(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == 8
    four = spark.range(0, 1000, 1, 4)
    assert spread(four) is four
