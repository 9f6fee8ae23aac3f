"""The driver's view: a fresh process outside the repository, a plain
default session, executors without the package on their path."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
df = E.entry(spark)
n = len(df.collect())
m = E.queries()["q22_comparison_vectors"](spark, "/root/testdata/sf0.001").count()
print("RESULT", n, m)
"""


def test_entry_runs_from_outside_the_repo():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="giftlink-contract-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=900)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-3000:]
    _, n, m = line[0].split()
    assert int(n) == 10 and int(m) == 53
