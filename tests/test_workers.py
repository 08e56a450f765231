"""Python workers import the package even when the driver runs elsewhere."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from basketlab.session import ship_package
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
ship_package(spark)
def keep(batches):
    import basketlab.schemas
    yield from batches
print("ROWS", spark.range(3).mapInArrow(keep, "id long").count())
spark.stop()
"""


def test_python_job_from_another_directory():
    with tempfile.TemporaryDirectory() as d:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env,
                           capture_output=True, text=True, timeout=300)
    assert "ROWS 3" in r.stdout, r.stderr[-2000:]
