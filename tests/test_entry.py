"""The driver contract, from a process that runs elsewhere with a plain session."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
assert e.entry(spark).count() > 0
assert e.queries()["cold_air_drainage"](spark, "/root/testdata/sf0.001").count() == 200
assert set(e.oracle_sql()) <= set(e.queries())
print("fine")
"""


def test_runs_from_another_folder(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]
