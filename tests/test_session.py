"""Sessions that were started elsewhere."""

import os
import subprocess
import sys

from tests.conftest import SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
print("rows", entry.queries()["rate_limit"](spark, {SMALL!r}).count())
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows " in done.stdout, done.stderr[-2000:]
