from types import SimpleNamespace

import pytest

from spineloom.durable import fresh_path, shared_folder


def session(master, conf=None, checkpoint=None):
    context = SimpleNamespace(master=master, folder=checkpoint)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: conf or default))


def test_the_named_folder_is_used():
    assert shared_folder(session("yarn", conf="hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    assert shared_folder(session("yarn", checkpoint="hdfs://given")) == "hdfs://given"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_local_mode_gets_a_folder_once():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    assert fresh_path(local, "x") != fresh_path(local, "x")
