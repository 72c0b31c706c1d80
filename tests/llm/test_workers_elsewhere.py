"""Operators run where Python workers cannot import this repository."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as E
import corpus_pipeline as P
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
def imports(batches):
    import importlib.util
    for batch in batches:
        yield batch.assign(id=int(importlib.util.find_spec("ratebridge") is not None))
assert spark.range(1).mapInPandas(imports, "id long").first()[0] == 0, "the workers can import the package"
sf = "/root/testdata/sf0.001"
for name in sorted(E.queries()):
    if name.startswith("op") and name[2].isdigit():
        assert E.queries()[name](spark, sf).count() > 0, name
assert P.run(spark, sf).count() > 0
print("all ran")
"""


def test_all_operators_and_the_pipeline(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and "all ran" in done.stdout, done.stderr[-3000:]
