"""Operators run in a fresh process outside the repository, whose executors
do not have the package on their path."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from giftlink.llm import registry
for name in ("op1_cotraining", "op2_packing", "op4_token_counts", "op5_suffix_dedup", "op7_permutation_index",
             "op8_sentence_pieces", "op10_order_minhash"):
    print("RESULT", name, registry.QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_executors_need_no_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="giftlink-ship-"), env=env,
                         capture_output=True, text=True, timeout=900)
    assert out.stdout.count("RESULT") == 7, out.stderr[-3000:]
