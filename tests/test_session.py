"""Where intermediate data goes."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from lakeops.session import RUNTIME_OPTIONS, scratch_path, shared_dir, staged, tune
from tests.conftest import rows


class Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, name, default=None):
        return self.folder if name == "spark.checkpoint.dir" else default


class Context:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class Session:
    def __init__(self, folder=None):
        self.conf = Conf(folder)
        self.sparkContext = Context()


def test_a_cluster_names_its_shared_folder():
    assert shared_dir(Session("hdfs:///tmp/checkpoints/")) == "hdfs:///tmp/checkpoints"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_scratch_paths_are_new_and_below_the_shared_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_staged_rows_are_read_back(spark):
    frame = spark.range(3).selectExpr("id", "cast(null as string) as name")
    back = staged(frame, "x")
    assert rows(back) == rows(frame) and back.dtypes == frame.dtypes


def test_runtime_options_can_be_set_on_a_running_session(spark):
    tune(spark)
    assert all(spark.conf.get(name) == value for name, value in RUNTIME_OPTIONS.items())


def test_what_a_process_has_staged_goes_with_it(tmp_path):
    script = (
        "from lakeops.session import build_session, staged\n"
        f"spark = build_session('x', 'local[1]', spark__checkpoint__dir='{tmp_path}')\n"
        "print(staged(spark.range(3), 'x').count())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ran = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120)
    assert ran.stdout.split() == ["3"]
    assert (tmp_path / "lakeops").is_dir() and not list(tmp_path.rglob("*.parquet"))
