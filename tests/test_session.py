import pytest

from huddlekit.session import cluster_settings, ensure_checkpoint_dir


def test_cluster_settings_bounds():
    tb = 1 << 40
    assert cluster_settings(100 * tb, 8000)["spark.sql.shuffle.partitions"] == str(100 * tb >> 27)
    assert cluster_settings(1 << 20, 64)["spark.sql.shuffle.partitions"] == str(3 * 64)
    s = cluster_settings(10 * tb, 1000)
    assert s["spark.sql.adaptive.enabled"] == "true" and s["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_dir_read_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured


def test_checkpoint_dir_must_be_set_off_local():
    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)
