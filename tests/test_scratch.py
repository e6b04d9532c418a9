from types import SimpleNamespace

import pytest

from treeferry.scratch import new_folder, shared_folder


def session(master, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master))
    assert shared_folder(session(master, "hdfs://nn/shared/")) == "hdfs://nn/shared"


def test_every_folder_is_new():
    one = session("yarn", "hdfs://nn/shared")
    assert new_folder(one, "x") != new_folder(one, "x")


def test_local_mode_sets_its_own():
    one, made = session("local[2]"), []
    one.sparkContext.setCheckpointDir = made.append
    one.sparkContext.getCheckpointDir = lambda: made[-1] + "/own" if made else None
    assert shared_folder(one).startswith("file:///") and shared_folder(one) == shared_folder(one) and len(made) == 1
