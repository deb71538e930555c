"""The shared folder: read from the session, an error instead of a local folder on a cluster."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from runlens.session import shared_dir


def fake(master: str, setting: str | None = None):
    conf = SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)
    sc = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key, default=None: None), getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=conf, sparkContext=sc)


def test_the_setting_is_used_as_it_is():
    assert shared_dir(fake("spark://host:7077", "hdfs://store/shared/")) == "hdfs://store/shared"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_without_the_setting_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake(master))


def test_a_remote_client_without_the_setting_is_an_error():
    class Remote:
        conf = SimpleNamespace(get=lambda key, default=None: default)

        @property
        def sparkContext(self):
            raise AttributeError("no SparkContext on the client")

    with pytest.raises(RuntimeError, match="remote client"):
        shared_dir(Remote())


def test_a_path_without_scheme_is_resolved_like_sparks(spark, tmp_path):
    from runlens.session import _qualified
    assert _qualified(spark.sparkContext, str(tmp_path)) == f"file:{tmp_path}"
    assert _qualified(spark.sparkContext, "s3a://bucket/x") == "s3a://bucket/x"
