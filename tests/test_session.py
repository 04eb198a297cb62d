"""Shared folders and shipping the package."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from tickloom.session import shared_folder

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _session(master, folder=None):
    conf = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get, set=conf.__setitem__), sparkContext=SimpleNamespace(master=master)
    )


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_session(master), "x")
    assert shared_folder(_session(master, "hdfs://x/y/"), "x").startswith("hdfs://x/y/tickloom/x-")


def test_local_sessions_keep_one_temporary_folder():
    s = _session("local[4]")
    assert os.path.dirname(shared_folder(s, "a")) == os.path.dirname(shared_folder(s, "b"))


def test_workers_import_the_package_from_any_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
from tickloom.session import builder
s = builder().master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", e.queries()["iforest_trees"](s, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]
