"""Hot keys: ranks over one partition, joins on a key with half of the rows, targets of which few rows are read; results and the largest task."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowspark.errors import RecipeError
from flowspark.operators.keyfilter import blocks_for, pruned, within_ranges
from flowspark.operators.ranking import distributed_rank, with_rank
from flowspark.operators.relational import equi_join, natural_join
from flowspark.operators.skew import heavy_keys, parts_of
from flowspark.plans.compiler import compile_script
from flowspark.plans.executor import Executor
from flowspark.sinks.parquet import OutputConfig, write


def largest_reads(spark, work):
    """For each stage that work runs, the records that its largest task reads from shuffles, and those of all its tasks."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def stages():
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()) for s in (found.apply(i) for i in range(found.size()))}

    before = stages()
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    out = []
    for stage, attempt in stages() - before:
        tasks = store.taskList(stage, attempt, 10_000)
        read = [t.taskMetrics().get().shuffleReadMetrics().recordsRead() for t in (tasks.apply(i) for i in range(tasks.size())) if t.taskMetrics().isDefined()]
        out.append((max(read, default=0), sum(read)))
    return out


@pytest.fixture()
def eight_parts(spark):
    """Eight shuffle partitions that stay as they are."""
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def ties(n, seed=1):
    rng = random.Random(seed)
    some = lambda xs: None if rng.random() < 0.1 else rng.choice(xs)
    return [(i, some(["a", "a", "a", "b", "ñ", ""]), some(range(6)), some([0.5, -0.0, 0.0, float("nan"), 2.5])) for i in range(n)]


@pytest.mark.parametrize("down", [False, True])
@pytest.mark.parametrize("partition", [[], ["g"], ["g", "x"]])
def test_rank_equals_the_window(spark, partition, down):
    df = spark.createDataFrame(ties(400), "id long, g string, x int, y double")
    order = [F.col(c) for c in ("x", "y") if c not in partition]
    got = distributed_rank(df, [F.col(c) for c in partition], order, down, 1, "r")
    by = Window.partitionBy(*partition).orderBy(*[c.desc() if down else c.asc() for c in order])
    want = df.withColumn("r", F.rank().over(by))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # Row numbers: each once, in the order of the ranks.
    numbered = distributed_rank(df, [F.col(c) for c in partition], order, down, 4, "n").withColumn("r", F.rank().over(by))
    groups = {}
    for r in numbered.collect():
        groups.setdefault(tuple(r[c] for c in partition), []).append((r["n"], r["r"]))
    for rows in groups.values():
        rows.sort()
        assert [n for n, _ in rows] == list(range(1, len(rows) + 1)) and [r for _, r in rows] == sorted(r for _, r in rows)


def test_rank_of_nothing_and_of_a_replaced_column(spark):
    df = spark.createDataFrame(ties(30), "id long, g string, x int, y double")
    assert distributed_rank(df.limit(0), [], [F.col("x")], False, 1, "r").count() == 0
    got = with_rank(df, [], [F.col("id") * 2], True, 1, "x")
    assert got.columns == ["id", "g", "y", "x"] and {(r["id"], r["x"]) for r in got.collect()} == {(i, 30 - i) for i in range(30)}


@pytest.mark.parametrize("mode", [1, 4])
def test_one_partition_over_many_tasks(eight_parts, mode):
    spark, n = eight_parts, 40_000
    df = spark.range(n).select("id", F.lit("one").alias("g"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") * 7919 % n).alias("v"))
    reads = largest_reads(spark, lambda: with_rank(df, [F.col("g")], [F.col("v")], False, mode, "r", hot_rows=1000).write.format("noop").mode("overwrite").save())
    alone = largest_reads(spark, lambda: with_rank(df, [F.col("g")], [F.col("v")], False, mode, "r").write.format("noop").mode("overwrite").save())
    assert max(most for most, _ in alone) == n
    assert all(most < 0.4 * total for most, total in reads if total > 5_000)  # eight tasks; two or three ranges may meet in one


def test_script_ranks_over_the_whole_table(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 5.0), (4, None)], "id long, v double")
    executor = Executor(spark)
    executor.register("t", df)
    text = "r: LOAD *, If(Window(WRank(1,1), 'DESC', v) <= 2, 'alto', 'bajo') AS clase, Window(WRank(1,1), 'ASC', v) AS p RESIDENT t;"
    got = executor.run(compile_script(text, ("t",)))["r"]
    assert got.columns == ["id", "v", "clase", "p"]
    assert sorted(map(tuple, got.collect())) == [(1, 5.0, "alto", 2), (2, 7.0, "alto", 4), (3, 5.0, "alto", 2), (4, None, "bajo", 1)]


def halves(spark, n=40_000):
    """A key with half of the rows, null for a tenth, and others."""
    key = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v")), spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 3).alias("w"))


@pytest.mark.parametrize("kind", ["LEFT", "INNER"])
def test_split_keys_give_the_same_rows(spark, kind):
    left, right = halves(spark, 4_000)
    right = right.union(right.filter("k < 3"))  # several partners
    want = sorted(map(repr, natural_join(left, right, kind).collect()))
    assert sorted(map(repr, natural_join(left, right, kind, 0.05).collect())) == want
    other = right.withColumnRenamed("k", "clave").withColumn("v", F.lit(-1))
    got, plain = (equi_join(left, other, "k = clave", kind, share).drop("clave").select("k", "v", "w") for share in (0.05, None))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect())) == want


def test_a_heavy_key_over_many_tasks(eight_parts):
    spark, (left, right) = eight_parts, halves(eight_parts)
    found, total = heavy_keys(left, [F.col("k")], 0.05)
    assert total == 40_000 and len(found) == 1 and abs(next(iter(found.values())) - 20_000) < 2_000
    assert 14 <= parts_of(found, total, 8)[next(iter(found))] <= 18
    reads = {share: max(most for most, _ in largest_reads(spark, lambda s=share: natural_join(left, right, "LEFT", s).write.format("noop").mode("overwrite").save())) for share in (None, 0.05)}
    assert reads[None] > 20_000 and reads[0.05] < 12_000  # an even share is 5000


def test_keys_of_other_types_and_none(spark):
    left = spark.createDataFrame([(1, "x")] * 50 + [(2, "y")], "k int, v string")
    right = spark.createDataFrame([(1, "r")], "k long, w string")
    assert natural_join(left, right, "LEFT", 0.1).filter("w = 'r'").count() == 50
    assert natural_join(left.limit(0), right.withColumn("k", F.col("k").cast("int")), "LEFT", 0.1).count() == 0
    nulls = left.withColumn("k", F.lit(None).cast("int"))
    assert natural_join(nulls, right.withColumn("k", F.col("k").cast("int")), "LEFT", 0.1).filter("w IS NULL").count() == 51


@pytest.mark.parametrize("kind", ["bigint", "string", "decimal(20,2)", "date", "timestamp", "binary", "double"])
def test_no_key_is_held_back(spark, kind):
    make = {"date": "date_add('1990-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id)", "binary": "cast(cast(id as string) as binary)"}.get(kind, f"cast(id as {kind})")
    old = spark.range(0, 30_000).selectExpr(f"{make} AS k", "cast(id % 2 as int) AS z")
    keys = spark.range(0, 40_000, 37).selectExpr(f"{make} AS k", "cast(id % 2 as int) AS z")
    got = pruned(old, keys, ["k", "z"], keys.count())
    wanted = old.join(keys, ["k", "z"], "left_semi").count()
    assert got.join(keys, ["k", "z"], "left_semi").count() == wanted
    if kind != "double":
        assert wanted <= got.count() < wanted + 600


def test_filters_stay_within_their_bound(spark):
    assert (blocks_for(0), blocks_for(2048), blocks_for(2049)) == (1, 1, 2)
    assert blocks_for(40_000_000) == 8192 and blocks_for(100_000_000) == 0
    df = spark.range(10)
    assert pruned(df, df.limit(0), ["id"], 0).count() == 0
    assert pruned(df, df, ["id"], 100_000_000).count() == 10  # too many keys: ranges only


@pytest.mark.parametrize("folders", [[], ["g"], ["g", "h"]])
def test_files_of_a_planned_size(spark, tmp_path, folders):
    """One folder with most of the rows, one of null, small ones, and an id of which each file has its own."""
    g = F.when(F.col("id") % 10 < 7, "most").when(F.col("id") % 10 == 7, None).when(F.col("id") % 10 == 8, F.concat(F.lit("g"), F.col("id") % 40)).otherwise("some")
    df = spark.range(60_000, numPartitions=3).select("id", g.alias("g"), (F.col("id") % 2).cast("int").alias("h"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    out = OutputConfig.of({"particionar_por": folders, "tamano_archivo_mb": 0.25, "modo": "append", "compresion": "none"})
    told = write(spark, df, f"{tmp_path}/t", out)
    files: dict = {}
    for p in (tmp_path / "t").rglob("*.parquet"):
        files.setdefault(p.parent, []).append(p.stat().st_size / (1 << 20))
    assert told["cantidad_archivos_parquet"] == sum(map(len, files.values()))
    assert sum(sum(f) for f in files.values()) / 0.25 / 2 < sum(map(len, files.values()))
    for sizes in files.values():
        assert max(sizes) < 0.5 and (min(sizes) > 0.125 or len(sizes) == 1)
    got = spark.read.parquet(f"{tmp_path}/t").select("id", "g", "h", "v")
    assert got.exceptAll(df).count() == 0 and got.count() == 60_000
    empty = write(spark, df.limit(0), f"{tmp_path}/e", OutputConfig.of({"tamano_archivo_mb": 1})) if not folders else None
    assert empty is None or spark.read.parquet(f"{tmp_path}/e").count() == 0
    with pytest.raises(RecipeError):
        OutputConfig.of({"tamano_archivo_mb": 1, "numero_particiones": 3})


def test_ranges_reach_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    old = spark.read.parquet(f"{tmp_path}/t").filter(within_ranges(spark.range(10, 20), ["id"]))
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThanOrEqual(id,19)" in plan and old.count() == 10


@pytest.mark.parametrize("folders", [6, 30])
def test_folders_with_a_number_of_files(spark, tmp_path, folders):
    """A task that writes a few folders doesn't hold its rows to sort them; more folders than are open at a time lose nothing."""

    def written(n, name):
        df = spark.range(n).select("id", (F.col("id") % folders).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        told = write(spark, df, f"{tmp_path}/{name}", OutputConfig.of({"numero_particiones": 3, "columnas_reparticion": ["id"], "particionar_por": ["g"]}))
        assert told["cantidad_archivos_parquet"] == 3 * folders
        got = spark.read.parquet(f"{tmp_path}/{name}").select("id", F.col("g").cast("long"), "v")
        assert got.count() == n and got.exceptAll(df).count() == 0

    def most_memory(work):
        store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
        stages = lambda: {(s.stageId(), s.attemptId()) for s in map(found().apply, range(found().size()))}
        found = lambda: store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        before = stages()
        work()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        tasks = [t for stage in stages() - before for t in (lambda ts: map(ts.apply, range(ts.size())))(store.taskList(*stage, 10_000))]
        return max(t.taskMetrics().get().peakExecutionMemory() for t in tasks if t.taskMetrics().isDefined())

    conf = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    written(9_000, "t")
    if folders < 8:
        df = spark.range(300_000).select("id", (F.col("id") % folders).alias("g"))
        assert most_memory(lambda: write(spark, df, f"{tmp_path}/m", OutputConfig.of({"numero_particiones": 3, "particionar_por": ["g"]}))) < 1 << 20
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == conf


@pytest.mark.parametrize("mode", [1, 4])
@pytest.mark.parametrize("partition", [[], ["g"], ["g", "x"]])
def test_rank_where_nothing_can_be_broadcast(spark, monkeypatch, partition, mode):
    monkeypatch.setattr("flowspark.operators.ranking.FEW", 0)
    df = spark.createDataFrame(ties(400), "id long, g string, x int, y double")
    order = [F.col(c) for c in ("x", "y", "id") if c not in partition][: None if mode == 4 else -1]
    by = Window.partitionBy(*partition).orderBy(*[c.desc() for c in order])
    got = distributed_rank(df, [F.col(c) for c in partition], order, True, mode, "r")
    want = df.withColumn("r", (F.rank() if mode == 1 else F.row_number()).over(by))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("mode", [1, 4])
@pytest.mark.parametrize("partition", [[], ["g"]])
def test_ranks_shuffle_rows_once_at_most(eight_parts, partition, mode):
    """Few orders are looked up without a shuffle of the rows; row numbers take one sort."""
    spark, n = eight_parts, 40_000
    df = spark.range(n).select("id", (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % (50 if mode == 1 else n)).alias("v"))
    reads = largest_reads(spark, lambda: distributed_rank(df, [F.col(c) for c in partition], [F.col("v")], True, mode, "r").write.format("noop").mode("overwrite").save())
    assert sum(total for _, total in reads) < (n / 4 if mode == 1 else 1.2 * n)
