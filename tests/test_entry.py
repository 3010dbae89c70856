"""The registry without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import __spark_entry__ as entry
from pyspark.sql import SparkSession

names = entry.queries()
assert len(names) == {expected}, len(names)
assert not any(n.startswith("op") or n == "pipeline" for n in names)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert names["clean_customers"](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_imports_without_corpus_operators(tmp_path):
    """A copy without the corpus folders, with and without the pipeline file, lists the other queries and runs one."""
    from riskframe.plans.catalog import QUERIES

    leave = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md", "*.txt")
    for pipeline in (True, False):
        copy = tmp_path / f"copy-{pipeline}"
        shutil.copytree(ROOT, copy, ignore=leave if pipeline else lambda d, names: leave(d, names) | {"corpus_pipeline.py"})
        ran = subprocess.run([sys.executable, "-c", PROBE.format(expected=len(QUERIES))], cwd=copy, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=300)
        assert ran.returncode == 0, ran.stderr[-2000:]
