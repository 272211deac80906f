"""A local session that names no shared folder still runs every registered query."""

import os
import subprocess
import sys

from conftest import ROOT, SF_DIR

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
print("rows", __spark_entry__.queries()["stored_metrics_document"](spark, {SF_DIR!r}).count())
"""


def test_query_without_a_named_folder(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)},
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows" in done.stdout
