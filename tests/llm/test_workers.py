"""Executors need not have this repository on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import os, sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())

@F.udf("boolean")
def absent():
    import importlib.util
    return importlib.util.find_spec("stayflow") is None

sys.path.insert(0, {REPO!r})
assert spark.range(8).select(absent()).distinct().collect()[0][0]
from stayflow.llm import queries
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
for name, fn in queries.queries().items():
    n = fn(spark, "/root/testdata/sf0.001").count()
    assert n > 0 and (n == docs or name[:4] in ("op4_", "op7_", "op8_")), (name, n)
print("all ran")
"""


def test_every_query_runs_with_workers_that_lack_the_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
