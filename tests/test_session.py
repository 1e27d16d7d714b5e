from types import SimpleNamespace

import pytest

from tidemark.session import checkpoint_root, shared_dir


class Context:
    def __init__(self, master, directory=None):
        self.master, self.directory = master, directory

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, directory):
        self.directory = directory + "/set"


def session(master, setting=None, directory=None):
    conf = SimpleNamespace(get=lambda key, default: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master, directory))


def test_the_cluster_setting_is_used():
    cluster = session("yarn", "s3a://bucket/shared")
    assert checkpoint_root(cluster) == "s3a://bucket/shared"
    assert cluster.sparkContext.directory.startswith("s3a://bucket/shared")
    assert shared_dir(cluster, "x").startswith("s3a://bucket/shared/x-")


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_root(session("spark://host:7077"))


def test_a_local_session_makes_its_own_folder_once():
    local = session("local[2]")
    first = checkpoint_root(local)
    assert "tidemark-" in first and checkpoint_root(local) == first
    assert checkpoint_root(session("yarn", None, "hdfs:/c/1")) == "hdfs:/c/1"
