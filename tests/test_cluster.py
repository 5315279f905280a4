"""Queries with a database where executors are processes of their own, as on a cluster."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pyspark
import pytest

from flowspark.queries import ORACLES

from .test_queries import DATA, rows

REPO = Path(__file__).resolve().parents[1]
PROGRAM = """
import json, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "1g").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
sys.path.insert(0, {repo!r})
from flowspark.queries import QUERIES
for name in {names!r}:
    QUERIES[name](spark, {data!r}).toPandas().to_parquet(f"{out}/{{name}}.parquet")
"""
NAMES = ["jdbc_round_trip", "jdbc_even_parts", "script_warehouse"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_databases_on_a_cluster(tmp_path):
    home = tmp_path / "home"  # executors write their logs to Spark's home
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():
        (home / p.name).symlink_to(p)
    program = PROGRAM.format(shared=f"file://{tmp_path}/shared", repo=str(REPO), names=NAMES, data=DATA, out=tmp_path)
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600, check=False)
    duck = duckdb.connect()
    for f in os.listdir(DATA):
        duck.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    for name in NAMES:
        assert (tmp_path / f"{name}.parquet").exists(), done.stderr[-3000:]
        assert rows(duckdb.sql(f"SELECT * FROM '{tmp_path}/{name}.parquet'").df()) == rows(duck.sql(ORACLES[name]).df())


def test_rows_of_a_database_in_files_come_back(spark):
    """Quotes, commas, line ends, blanks and nulls; two loads into one table; a table without rows."""
    from flowspark.sources import embedded
    from flowspark.sources.catalog import Secrets
    from flowspark.sources.jdbc import TargetDatabase

    some = [(1, 'a"b,c\nd', 0.1, True), (2, "", -1e300, None), (3, None, None, False), (4, "  'ñ' \\ ", 5e-324, True)]
    df = spark.createDataFrame(some, "k int, t string, x double, b boolean").selectExpr("*", "cast(k as decimal(12,2)) AS d", "date_add('1999-12-31', k) AS f", "timestamp_millis(k * 1001L) AS z")
    url = embedded.new_database()
    for mode, part in (("overwrite", df), ("overwrite", df.filter("k < 3")), ("append", df.filter("k >= 3")), ("ignore", df)):
        TargetDatabase(url, embedded.DRIVER, mode=mode).write(part, "t", Secrets())
    TargetDatabase(url, embedded.DRIVER).write(df.filter("k > 9"), "nada", Secrets())
    url = embedded.sealed(spark, url)
    back = lambda name: spark.read.format("jdbc").options(url=url, driver=embedded.DRIVER, dbtable=f'"{name}"').load()
    assert sorted(map(repr, back("t").collect())) == sorted(map(repr, df.collect())) and back("nada").count() == 0
