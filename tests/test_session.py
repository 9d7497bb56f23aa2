from types import SimpleNamespace

import pytest

from tidemark.session import fresh_dir, shared_dir


def fake(master, conf=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint, setCheckpointDir=lambda path: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: conf or default))


def test_the_configured_folder_is_used():
    assert shared_dir(fake("spark://host", conf="s3a://lake/tmp/")) == "s3a://lake/tmp"
    assert shared_dir(fake("spark://host", checkpoint="hdfs:/ck")) == "hdfs:/ck"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(fake("spark://host"))


def test_fresh_paths_differ(spark):
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))
