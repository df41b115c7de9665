"""A driver started elsewhere, which alone knows where the package lies."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

DRIVER = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from pitwall.operators.rank import row_numbers
from pitwall.sources.tables import read_table
nation = read_table(spark, {sf!r}, "nation")
from pyspark.sql import functions as F
out = row_numbers(nation, ["n_regionkey"], [F.col("n_nationkey")], "place")
print("rows", out.count(), out.agg(F.max("place")).first()[0])
"""


def test_workers_get_the_package(sf_small, tmp_path):
    code = DRIVER.format(root=ROOT, sf=sf_small)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 25 5" in done.stdout, done.stderr[-2000:]
