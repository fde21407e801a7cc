"""The operators that broadcast a model run on workers that do not have the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOB = f"""
import sys
sys.path.insert(0, {ROOT!r})  # the driver alone
from pyspark.sql import SparkSession
from partqc.llm import langid, queries
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())

def has_package(batches):
    import importlib.util
    for batch in batches:
        found = importlib.util.find_spec("partqc") is not None
        yield batch.slice(0, 1).select(["id"]) if found else batch.slice(0, 0).select(["id"])

assert spark.range(2).mapInArrow(has_package, "id long").count() == 0
sf = "/root/testdata/sf0.001"
n = spark.read.parquet(sf + "/documents.parquet").count()
for name in ("op2_sentencepiece", "op4_quality", "op8_language_id"):
    assert len(queries.QUERIES[name](spark, sf).collect()) == n, name
langid.automaton.__defaults__ = (0,)  # transitions as sorted cells
docs = spark.read.parquet(sf + "/documents.parquet")
assert len(langid.identify_language(docs, sample_chars=2000).collect()) == n
print("done")
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_LOCAL_DIRS")}
    done = subprocess.run([sys.executable, "-c", JOB], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and done.stdout.endswith("done\n"), done.stderr[-3000:]
