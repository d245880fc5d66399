from __future__ import annotations

import os

import pytest

from pulso import session


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()


class _Cluster:
    conf = _Conf()
    sparkContext = _Context()


def test_cluster_without_checkpoint_folder_raises():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster())


def test_local_cluster_counts_as_cluster():
    sc = _Context()
    assert not session._is_local(sc)
    sc.master = "local-cluster[2,1,1024]"
    assert not session._is_local(sc)
    sc.master = "local[4]"
    assert session._is_local(sc)


def test_stages_are_released(spark):
    df = session.materialize(spark.range(5), "release-test")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 5 and os.path.isdir(folder)
    assert session.release_stages(spark) >= 1
    assert not os.path.exists(folder)
