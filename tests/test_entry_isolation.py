"""The driver imports __spark_entry__ from its own working directory: Python
tasks must not depend on this package being importable on executors."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
n = entry.queries()["cards_by_class"](spark, "/root/testdata/sf0.001").count()
s = entry.entry(spark).collect()
print("RESULT", n, len(s))
"""


def test_python_tasks_run_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "RESULT 50 1" in out.stdout, out.stderr[-3000:]
