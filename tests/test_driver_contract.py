"""The driver imports __spark_entry__ from elsewhere with its own plain session: the
UDF modules must reach the Python workers without relying on the working directory."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
df = E.entry(spark)
print("ROWS", df.count())
"""


def test_entry_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="sifter-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=900)
    assert "ROWS 400" in out.stdout, out.stderr[-3000:]
