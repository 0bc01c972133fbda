"""Settings that follow the size of a run, and the shared folder."""

from types import SimpleNamespace

import pytest

from playerflow.session import run_dir, scale_settings, shared_dir


def test_partitions_follow_the_input():
    small = scale_settings(10 * 1024**3, 4, 16)
    large = scale_settings(100 * 1024**4, 4, 16)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))
    assert int(large["spark.sql.files.maxPartitionBytes"]) <= 512 * 1024**2


def test_configured_folder_is_used(tmp_path):
    """The setting is fixed when a session starts, so a stand-in carries it here."""
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: f"{tmp_path}/"))
    assert shared_dir(session) == str(tmp_path)
    assert run_dir(session, "x").startswith(f"{tmp_path}/playerflow/x-")
    assert run_dir(session, "x") != run_dir(session, "x")


def test_cluster_without_a_folder_is_an_error():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:1")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)
    with pytest.raises(RuntimeError):
        shared_dir(session)
