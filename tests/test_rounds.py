"""Long tables that are joined, ranked and stored a part at a time, and what they leave on disk."""

import json
import os

import pytest
from pyspark.sql import functions as F

from flowspark.operators import rounds
from flowspark.plans.compiler import compile_script
from flowspark.plans.executor import Executor
from flowspark.queries import QUERIES, table
from flowspark.shared import shared_folder
from flowspark.sources import embedded
from flowspark.sources.catalog import Secrets, load_catalog
from flowspark.sources.jdbc import TargetDatabase

DATA = "/root/testdata/sf0.01"
STORES = "STORE u INTO [lib://datos/u.csv] (csv); STORE v INTO [lib://datos/v.csv] (csv);"
JOINS = "LEFT JOIN (a) LOAD k, z RESIDENT b; LEFT JOIN (a) LOAD z, w RESIDENT c;"
SCRIPTS = {
    "ranks": f"{JOINS} r: LOAD *, Window(WRank(1,1), g, w, 'DESC', y) AS puesto; LOAD *, x + y AS neto RESIDENT a; DROP TABLE a; u: LOAD * RESIDENT r WHERE puesto < 9; v: LOAD g, Sum(neto) AS s, Max(puesto) AS m RESIDENT r GROUP BY g;",
    "two ranks": f"{JOINS} r: LOAD k, x, Window(WRank(4,1), g, 'ASC', x) AS p, Window(WRank(1,1), w, 'ASC', y) AS q RESIDENT a; u: LOAD k, p RESIDENT r; v: LOAD q, Count(*) AS n RESIDENT r GROUP BY q;",
    "whole ranks": f"{JOINS} r: LOAD k, x, w, Window(WRank(1,1), 'ASC', y) AS q RESIDENT a; u: LOAD k, q RESIDENT r; v: LOAD q, Count(*) AS n RESIDENT r GROUP BY q;",
    "renamed": "LEFT JOIN (a) LOAD k, z RESIDENT b; t: LOAD k AS llave, x, z RESIDENT a; LEFT JOIN (t) LOAD z, w RESIDENT c; u: LOAD llave, w RESIDENT t; v: LOAD w, Sum(x) AS s RESIDENT t GROUP BY w;",
    "left out": f"{JOINS} t: LOAD x, g, w RESIDENT a; LEFT JOIN (t) LOAD w, Count(*) AS n RESIDENT c GROUP BY w; u: LOAD * RESIDENT t; v: LOAD g, Sum(n) AS s RESIDENT t GROUP BY g;",
    "distinct": f"{JOINS} t: LOAD DISTINCT k, g, w RESIDENT a; u: LOAD k, w RESIDENT t; v: LOAD g, Count(*) AS n RESIDENT t GROUP BY g;",
    "distinct ranks": f"{JOINS} t: LOAD DISTINCT g, Window(WRank(1,1), g, w, 'ASC', y) AS q RESIDENT a; u: LOAD * RESIDENT t; v: LOAD g, Count(*) AS n RESIDENT t GROUP BY g;",
    "put together": f"{JOINS} CONCATENATE (a) LOAD k, x RESIDENT d; u: LOAD k, x, w RESIDENT a; v: LOAD w, Count(*) AS n RESIDENT a GROUP BY w;",
    "long partner": f"{JOINS} LEFT JOIN (d) LOAD k, w RESIDENT a; u: LOAD k, x, w RESIDENT d; v: LOAD w, Count(*) AS n RESIDENT d GROUP BY w;",
    "sums": f"{JOINS} t: LOAD k, Sum(x) AS s, Max(w) AS w RESIDENT a GROUP BY k; u: LOAD k, s RESIDENT t; v: LOAD w, Count(*) AS n RESIDENT t GROUP BY w;",
}


def tables(spark):
    null = lambda n, c: F.when(F.col("id") % n != 0, c)
    return {
        "a": spark.range(300).select(null(11, F.col("id") % 90).alias("k"), (F.col("id") * 7).alias("x"), (F.col("id") * 13 % 40 / 4).alias("y"), null(7, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), F.lit(None).alias("nada")),
        "b": spark.range(80).select(F.col("id").alias("k"), null(6, F.col("id") % 9).alias("z")),
        "c": spark.range(7).select(F.col("id").alias("z"), F.concat(F.lit("w"), F.col("id") % 3).alias("w")),
        "d": spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")),
    }


def run(spark, text, folder, **options):
    catalog = load_catalog(json.dumps({"locales": [{"nombre": "datos", "tipo": "local", "ruta_base": str(folder)}]}), inline=True)
    executor = Executor(spark, catalog, tables=tables(spark), **options)
    executor.run(compile_script(text, ("a", "b", "c", "d")))
    files = {f: sorted((folder / f).read_text().split("\n")) for f in ("u.csv", "v.csv")}
    live = {t: (df.columns, [k for _, k in df.dtypes], sorted(map(repr, df.collect()))) for t, df in executor.tables.items()}
    return executor, files, live


CASES = [(name, {}) for name in SCRIPTS] + [("ranks", {"hot_rows": 20}), ("ranks", {"skew_share": 0.02})]


def held(spark):
    """What scripts have stored in the shared folder."""
    return {f for f in os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) if f.startswith(("stored", "ranked"))}


@pytest.mark.parametrize(("name", "options"), CASES, ids=[" ".join([name, *options]) for name, options in CASES])
def test_rounds_change_nothing(spark, tmp_path, name, options):
    """Publications and live tables are the same whether a table takes one round or many; what was stored goes at the end."""
    shared_folder(spark, "any")
    before = held(spark)
    for d in ("one", "many"):
        (tmp_path / d).mkdir()
    executor, *one = run(spark, SCRIPTS[name] + STORES, tmp_path / "one", **options)
    executor.release()
    executor, *many = run(spark, SCRIPTS[name] + STORES, tmp_path / "many", round_rows=40, **options)
    assert one == many and one[0]["u.csv"][1:] and len(held(spark)) > len(before)
    executor.release()
    assert held(spark) == before


def test_a_job_takes_a_part_of_a_long_table(spark, tmp_path, monkeypatch):
    """Joins and ranks are stored by jobs none of which has much more rows than a round or a slice."""
    sizes, add = [], rounds.add
    monkeypatch.setattr(rounds, "add", lambda df, path, by=None: (sizes.append(df.count()), add(df, path, by)))
    run(spark, SCRIPTS["ranks"] + STORES, tmp_path, round_rows=40)
    joined, ranked = sizes[:8], sizes[8:]
    assert sum(joined) == sum(ranked) == 300 and max(joined) <= 2 * 40 and max(ranked) <= 150


def shuffle_files(spark):
    return {(root, n): os.path.getsize(f"{root}/{n}") for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs() for root, _, names in os.walk(d.getPath()) for n in names if n.startswith("shuffle_")}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_the_nightly_load_leaves_no_shuffles_and_no_tables(spark):
    """What its joins, ranks and publications shuffled is gone when it ends, and so is what it stored; nothing is cached."""
    spark.catalog.clearCache()
    shared_folder(spark, "any")
    before, stored = shuffle_files(spark), held(spark)
    found = QUERIES["script_warehouse"](spark, DATA)
    left = sum(n for f, n in shuffle_files(spark).items() if f not in before)
    assert left < 100_000 and not spark.sparkContext._jsc.getPersistentRDDs()
    assert held(spark) == stored and found.count() > 500


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_a_database_fills_its_pages_and_is_moved_table_by_table(spark, monkeypatch):
    orders, url = table(spark, DATA, "orders"), embedded.new_database()
    for name in ("pedidos", "otros"):
        TargetDatabase(url, embedded.DRIVER).write(orders, name, Secrets())
    place, n = embedded.IN_FILES.match(url)[1], orders.count()
    connection = embedded.connect(spark, url)
    kept = connection.createStatement().executeQuery(f"VALUES SYSCS_UTIL.SYSCS_GET_DATABASE_PROPERTY('{embedded.RESERVED}')")
    kept.next()
    assert kept.getString(1) is None
    connection.close()
    used = lambda: sum(os.path.getsize(f"{root}/{f}") for root, _, names in os.walk(place) for f in names if root.endswith("seg0"))
    most = max(os.path.getsize(f"{place}/seg0/{f}") for f in os.listdir(f"{place}/seg0"))
    assert n * 40 < most < n * 88
    seen, write = [], embedded.zipfile.ZipFile.write

    def written(jar, *args):
        write(jar, *args)
        seen.append(used() + jar.fp.tell())

    before = used()
    monkeypatch.setattr(embedded.zipfile.ZipFile, "write", written)
    sealed = embedded.sealed(spark, url)
    assert max(seen) < before + most + (4 << 20) and not os.path.exists(os.path.dirname(place))
    assert spark.read.format("jdbc").options(url=sealed, driver=embedded.DRIVER, dbtable='"otros"').load().count() == n
