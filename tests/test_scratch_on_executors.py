"""Scratch folders with executors that are processes of their own, in folders of their own."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark
from conftest import ROOT

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from curbstar.sources import scratch

conf = {
    "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "512m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1",
    "spark.checkpoint.dir": sys.argv[1], "spark.sql.shuffle.partitions": "2", "spark.ui.showConsoleProgress": "false",
}
spark = SparkSession.builder.config(map=conf).getOrCreate()
spark.conf.set("spark.master", "spark://127.0.0.1:7077")
try:
    kept = scratch.stored(spark.range(0, 100, 1, 4), "kept")
    print("rows", kept.count(), kept.inputFiles()[0].removeprefix("file://"), flush=True)
except ValueError as error:
    print("refused:", error, flush=True)
spark.stop()
"""


def _said(tmp_path, folder: str) -> str:
    """What a session on two executors says that keeps its scratch tables in ``folder``."""
    home, work = tmp_path / "home", tmp_path / "cwd"
    home.mkdir(parents=True)
    work.mkdir()
    for own in Path(pyspark.__file__).parent.iterdir():
        if own.name != "work":
            (home / own.name).symlink_to(own)
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", SCRIPT, folder], env=env, cwd=work, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_a_bare_path_that_all_executors_share_is_used(tmp_path):
    folder = tmp_path / "shared"
    assert f"rows 100 {folder}/curbstar/kept-" in _said(tmp_path / "run", str(folder))
    left = [p.name.split("-")[0] for p in (folder / "curbstar").iterdir()]
    assert left == ["kept"], "what was written for the trial is gone"


def test_a_bare_path_that_each_executor_has_for_itself_is_refused(tmp_path):
    assert "refused: /proc/self/cwd/own is a folder of one machine" in _said(tmp_path / "run", "/proc/self/cwd/own")
