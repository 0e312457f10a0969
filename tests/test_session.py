"""Session helpers: settings sized from the input volume; checkpoint folder
taken from the session when set."""

import os

import pytest

from starloom.session import cluster_conf, ensure_checkpoint_dir, scratch_path, scratch_scope


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30)
    big = cluster_conf(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"          # floor
    assert int(big["spark.sql.shuffle.partitions"]) == 186265      # 100 TB / 512 MB, rounded up
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_checkpoint_dir_comes_from_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_unset_checkpoint_dir_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_scope_removes_what_was_made_inside(spark):
    kept = scratch_path(spark, "kept")
    spark.range(1).write.parquet(kept)
    with scratch_scope(spark):
        inside = scratch_path(spark, "inside")
        spark.range(1).write.parquet(inside)
    local = lambda path: path.removeprefix("file://")
    assert not os.path.exists(local(inside)) and os.path.exists(local(kept))
