"""The Python operators where workers have no copy of the package, as on a cluster."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from ..test_queries import DATA

REPO = Path(__file__).resolve().parents[2]
QUERIES = ["op3_hmm", "op4_media", "op5_packing", "op6_warc", "op7_toxicity", "op9_mixing", "op10_minhash", "op11_tokens", "op12_runs"]
PROGRAM = """
import json, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
def seen(_):
    import importlib.util
    yield importlib.util.find_spec("flowspark") is not None
alone = not any(spark.sparkContext.parallelize(range(4), 4).mapPartitions(seen).collect())
sys.path.insert(0, {repo!r})
from flowspark.llm.queries import QUERIES
print("FOUND=" + json.dumps([alone, {{name: QUERIES[name](spark, {data!r}).count() for name in {names!r}}}]))
"""


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(repo=str(REPO), data=DATA, names=QUERIES)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600, check=False)
    lines = [x for x in done.stdout.splitlines() if x.startswith("FOUND=")]
    assert lines, done.stderr[-3000:]
    alone, counts = json.loads(lines[0].removeprefix("FOUND="))
    assert alone and all(counts.values()) and set(counts) == set(QUERIES)
