from types import SimpleNamespace

import pytest
from tabularium.checks.scratch import new_folder, shared_root, written_once


def session(**settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default))
    )


def test_the_shared_folder_is_the_one_the_session_names(tmp_path):
    assert shared_root(session(spark_checkpoint_dir="hdfs://nn/x/", spark_master="yarn")) == "hdfs://nn/x"


def test_a_local_folder_is_for_local_sessions_only():
    assert shared_root(session(spark_master="local[8]"))
    for master in ("yarn", "local-cluster[2,1,1024]", None):
        with pytest.raises(ValueError):
            shared_root(session(spark_master=master))


def test_folders_are_new_but_inputs_are_written_once(tmp_path):
    spark = session(spark_checkpoint_dir=str(tmp_path))
    assert new_folder(spark, "a") != new_folder(spark, "a")
    written = []
    first = written_once(spark, "raw", "sf", written.append)
    assert written_once(spark, "raw", "sf", written.append) == first
    assert written_once(spark, "raw", "other", written.append) != first
    assert written == [first, written_once(spark, "raw", "other", written.append)]
