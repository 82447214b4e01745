"""Checkpoint folder rules: the cluster's setting, or a local one only in local mode."""

import pytest

from duka.session import apply_defaults, ensure_checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, master, conf=None, current=None):
        self.master, self._conf, self._dir = master, _Conf(conf or {}), current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d + "/run"


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_uses_the_configured_shared_folder():
    s = _Session(_Context("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"}))
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt/run"


def test_keeps_an_existing_checkpoint_dir():
    s = _Session(_Context("k8s://x", current="s3://bucket/ckpt/abc"))
    assert ensure_checkpoint_dir(s) == "s3://bucket/ckpt/abc"


def test_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(_Session(_Context("spark://master:7077")))


def test_local_mode_gets_a_scratch_folder():
    s = _Session(_Context("local[4]"))
    assert ensure_checkpoint_dir(s).endswith("/run")


class _Settings(dict):
    set = dict.__setitem__


@pytest.mark.parametrize("launched, size", [({}, "16m"), ({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}, None)])
def test_shuffle_partitions_are_merged_to_small_ones_unless_launched_otherwise(launched, size):
    class Conf(_Conf):
        contains = dict.__contains__

    session = _Session(_Context("local[4]"))
    session.sparkContext._conf, session.conf = Conf(launched), _Settings()
    apply_defaults(session)
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size
