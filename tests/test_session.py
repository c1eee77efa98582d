from types import SimpleNamespace

import pytest

from spendlens import session


def _fake(master, conf):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(
        get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__))


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.ensure_checkpoint_dir(_fake(master, {}))


def test_the_named_folder_is_used():
    assert session.ensure_checkpoint_dir(_fake("yarn", {"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"
