"""The shared checkpoint folder comes from the session; a local temp folder is
made only in local mode, and a cluster without one is refused."""
import pytest

from salesmart.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)

    def set(self, k, v):
        self[k] = v


class _SC:
    def __init__(self, master):
        self.master = master
        self.dirs = []

    def setCheckpointDir(self, d):
        self.dirs.append(d)


class _Spark:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _SC(master)


def test_uses_the_session_folder():
    s = _Spark("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.dirs == ["hdfs://shared/ckpt"]


def test_local_mode_gets_a_scratch_folder():
    s = _Spark("local[4]")
    d = ensure_checkpoint_dir(s)
    assert d and s.conf["spark.checkpoint.dir"] == d


def test_cluster_without_folder_is_refused():
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(_Spark("yarn"))
