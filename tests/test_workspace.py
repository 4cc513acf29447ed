from __future__ import annotations

from pathlib import Path

import pytest

from clickloom import workspace


class _Conf:
    def get(self, key, default=None):
        return default


class _Cluster:
    """A session on a cluster without a shared folder."""

    conf = _Conf()

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.work_path(_Cluster(), "x")
    assert workspace.work_path(_Cluster(), "x", "hdfs:///shared/").startswith("hdfs:///shared/x-")


def test_the_named_folder_comes_first(tmp_path):
    class Named(_Cluster):
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "hdfs:///named/"}[key]

    assert workspace.work_path(Named(), "x").startswith("hdfs:///named/x-")


def test_scratch_folders_go(spark):
    with workspace.scratch(spark, "s") as path:
        workspace.materialize(spark.range(3), "t", f"{path}/t")
        assert Path(path).exists()
    assert not Path(path).exists()
