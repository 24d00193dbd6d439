"""Every registered entry against its SQL in DuckDB, at the smallest scale."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from conftest import final_plan

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


LLM = [*(entry.llm.QUERIES if entry.llm else []), *(["pipeline"] if entry.pipeline else [])]
OWN = [name for name in entry.queries() if name not in LLM]


@pytest.mark.parametrize("name", OWN)
def test_entry_against_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, DATA), con, entry.oracle_sql()[name]) is None


def test_every_own_entry_has_sql():
    assert set(OWN) == {name for name in entry.oracle_sql() if name not in LLM}


def test_entry(spark):
    assert entry.entry(spark).count() == 70


def test_csv_copies_are_made_anew(spark):
    first = entry.scan_csv_readings(spark, DATA).inputFiles()
    assert first and not set(first) & set(entry.scan_csv_readings(spark, DATA).inputFiles())
    assert entry.csv_readings(spark, "/root/testdata/sf0.01").count() > len(first)


@pytest.mark.parametrize("name", ["period_columns", "period_starts"])
def test_no_label_per_reading(spark, name):
    plan = final_plan(entry.queries()[name](spark, DATA))
    # Below the partial aggregate, which is printed after the exchange, nothing is formatted.
    assert "date_format" in plan and "date_format" not in plan[plan.rindex("partial_count") :]


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_import_without_text_operators(tmp_path, also):
    """A copy of the library without the optional package imports and registers the rest."""
    root = Path(entry.__file__).parent
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in also and (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    shutil.copytree(root / "gridstats", tmp_path / "gridstats", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), e.llm, e.pipeline, *sorted(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == ["True", "None", "None", *sorted(OWN)]
