"""The library without its optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
RUN = """
import __spark_entry__ as driver
from pyspark.sql import SparkSession

assert driver.queries() and not any(n.startswith("op") for n in driver.queries())
assert set(driver.oracle_sql()) <= set(driver.queries()) and "pipeline" not in driver.queries()
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert driver.queries()["kpis"](spark, driver.SMOKE_DATA).count() == 1
import tests.test_oracles
"""


def without_optional_parts(tmp_path, pipeline):
    left = shutil.ignore_patterns(".git", "__pycache__", "*.json", "llm")
    shutil.copytree(REPO, copy := tmp_path / f"copy-{pipeline}", ignore=left)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    return copy


def run(copy, program):
    return subprocess.run(
        [sys.executable, "-c", program], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)},
        capture_output=True, text=True, timeout=300,
    )


def test_entry_works_without_the_optional_parts(tmp_path):
    done = run(without_optional_parts(tmp_path, pipeline=False), RUN)
    assert done.returncode == 0, done.stderr[-2000:]


def test_entry_imports_where_only_the_pipeline_is_left(tmp_path):
    copy = without_optional_parts(tmp_path, pipeline=True)
    (copy / "newsflow" / "llm" / "__pycache__").mkdir(parents=True)
    done = run(copy, "import __spark_entry__ as d; assert 'pipeline' not in d.queries()")
    assert done.returncode == 0, done.stderr[-2000:]
