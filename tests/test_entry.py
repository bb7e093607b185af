"""The contract from outside: another folder, a plain session, the file loaded by its path."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .getOrCreate()
)
print("rows", entry.entry(spark).count())
print("rows", entry.queries()["workbook_scan"](spark, "/root/testdata/sf0.001").count())
"""


def test_from_another_folder(tmp_path):
    path = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(path)],
        cwd=tmp_path,
        capture_output=True,
        text=True,
        timeout=200,
        check=False,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    counts = [line for line in done.stdout.splitlines() if line.startswith("rows")]
    assert counts == ["rows 10", "rows 150"]
