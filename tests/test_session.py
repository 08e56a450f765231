"""Shared-folder rules: never a machine-local temporary folder on a cluster."""

import pytest

from basketlab import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Spark:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf, self.sparkContext = _Conf(dict(conf or {})), _SC(master, ckpt)


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Spark("yarn"))


def test_cluster_uses_the_configured_folder():
    s = _Spark("spark://head:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert session.shared_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt/"


def test_local_without_setting_gets_a_private_folder():
    s = _Spark("local[2]")
    d = session.shared_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d
