"""The entry points, also where the part that can be taken out is taken out."""

import os
import shutil
import subprocess
import sys

from workload import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_points_without_the_removable_part(tmp_path):
    for left in ((), ("corpus_pipeline.py",)):
        copy = tmp_path / f"copy{len(left)}"
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *left))
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
        run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
        assert run.returncode == 0, run.stderr
        assert run.stdout.split() == [str(len(catalog.QUERIES))] * 2


def test_stage2_scans_the_citations_once(spark, sf_dir):
    plan = catalog._stage2(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1, plan
    assert catalog._stored_stage2(spark, sf_dir) is catalog._stored_stage2(spark, sf_dir)
