"""Streams: incremental loads and the growing CSV file, stopped between any two phases and run again."""

import csv

import pytest
from pyspark.sql import functions as F

from flowspark.errors import FlowError
from flowspark.operators.incremental import IncrementalConfig
from flowspark.sinks.commit import CommitLog, data_files, names_in
from flowspark.sinks.parquet import OutputConfig
from flowspark.streaming.csv_sink import stream_to_csv
from flowspark.streaming.incremental import stream_incremental

CONFIG = IncrementalConfig.of({"activo": True, "claves": ["k"]})
SCHEMA = "k long, v long, g string"


class Stop(Exception):
    pass


def add(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def batches():
    return [[(i % 40, i + 100 * b, f"g{i % 3}") for i in range(b * 10, b * 10 + 30)] for b in range(4)]


def load(spark, folder, target, state, phase=lambda _n, _b: None, **output):
    return stream_incremental(source(spark, folder), target, CONFIG, OutputConfig.of({"modo": "append"} | output), state, phase=phase)


def rows(spark, target):
    return sorted((r.k, r.v, r.g) for r in spark.read.parquet(target).select("k", "v", "g").collect())


@pytest.mark.parametrize("stop", ["staged", "prepared", "moved", "committed"])
@pytest.mark.parametrize("output", [{}, {"particionar_por": ["g"], "numero_particiones": 2}])
def test_stopped_load_equals_one_run(spark, tmp_path, stop, output):
    for b in batches():
        add(spark, f"{tmp_path}/in", b)
    whole = load(spark, f"{tmp_path}/in", f"{tmp_path}/whole", f"{tmp_path}/a", **output)
    seen = []

    def phase(name, batch):
        seen.append((name, batch))
        if name == stop and batch in (0, 2) and seen.count((name, batch)) == 1:
            raise Stop(name)

    parts = []
    for _ in range(2):
        with pytest.raises(FlowError):
            load(spark, f"{tmp_path}/in", f"{tmp_path}/again", f"{tmp_path}/b", phase, **output)
    parts += load(spark, f"{tmp_path}/in", f"{tmp_path}/again", f"{tmp_path}/b", phase, **output)
    assert rows(spark, f"{tmp_path}/whole") == rows(spark, f"{tmp_path}/again")
    keys = [r[0] for r in rows(spark, f"{tmp_path}/again")]
    assert len(keys) == len(set(keys)) == len({r[0] for b in batches() for r in b})
    assert [m["total_registros"] for m in whole][-1] == len(keys) and parts[-1]["total_registros"] == len(keys)
    log = next(CommitLog(spark, f"{tmp_path}/b/commits/{n}") for n in names_in(spark, f"{tmp_path}/b/commits"))
    assert [d["metricas"]["nuevas"] for d in log.committed()] == [m["total_registros_nuevos"] for m in whole]
    assert not [n for n in names_in(spark, f"{tmp_path}/again") if n.startswith("_lote")]
    assert load(spark, f"{tmp_path}/in", f"{tmp_path}/again", f"{tmp_path}/b", **output) == []


def test_new_input_and_new_checkpoint(spark, tmp_path):
    first, *later = batches()
    add(spark, f"{tmp_path}/in", first)
    load(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/s")
    files = data_files(spark, f"{tmp_path}/t")
    for b in later:
        add(spark, f"{tmp_path}/in", b)
    found = load(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/s")
    assert [m["lote"] for m in found] == [1, 2, 3] and set(files) < set(data_files(spark, f"{tmp_path}/t"))
    before = rows(spark, f"{tmp_path}/t")
    again = load(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/other")  # begun anew: the keys are there
    assert sum(m["total_registros_nuevos"] for m in again) == 0 and rows(spark, f"{tmp_path}/t") == before


def test_null_keys_stop_the_stream(spark, tmp_path):
    add(spark, f"{tmp_path}/in", [(1, 1, "a"), (None, 2, "a")])
    with pytest.raises(FlowError) as e:
        load(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/s")
    assert e.value.code == "KEY_NULL" and not data_files(spark, f"{tmp_path}/t")
    with pytest.raises(FlowError) as e:
        stream_incremental(spark.range(1).withColumnRenamed("id", "k"), f"{tmp_path}/t", CONFIG, OutputConfig.of({"modo": "append"}), f"{tmp_path}/s")
    assert e.value.code == "STREAM_REQUIRED"


def lines(path):
    with open(path, encoding="utf-8", newline="") as f:
        return list(csv.reader(f))


def test_csv_grows_by_what_is_new(spark, tmp_path):
    target = tmp_path / "out.csv"
    add(spark, f"{tmp_path}/in", [(1, 1, 'a "b", c'), (2, 2, None)])
    told = stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target)
    first = target.read_bytes()
    assert told.bytes == len(first) and lines(target) == [["k", "v", "g"], ["1", "1", 'a "b", c'], ["2", "2", ""]]
    same = stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target)
    assert same.sha256 == told.sha256 and target.read_bytes() == first
    for b in batches():
        add(spark, f"{tmp_path}/in", b)
    stream_to_csv(source(spark, f"{tmp_path}/in"), f"file://{tmp_path}/s", f"file://{target}")
    assert target.read_bytes().startswith(first) and len(lines(target)) == 3 + 4 * 30
    target.write_text("someone else's", encoding="utf-8")
    add(spark, f"{tmp_path}/in", batches()[0])
    with pytest.raises(FlowError) as e:
        stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target)
    assert e.value.code == "PUBLISH_CONFLICT" and target.read_text("utf-8") == "someone else's"


@pytest.mark.parametrize("stop", ["told", "moved"])
@pytest.mark.parametrize("turn", [0, 1])
def test_csv_stopped_between_phases(spark, tmp_path, stop, turn):
    target = tmp_path / "out.csv"

    def phase(name):
        if name == stop:
            raise Stop(name)

    for i, b in enumerate(batches()[:2]):
        add(spark, f"{tmp_path}/in", b)
        if i == turn:
            with pytest.raises(Stop):
                stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target, phase=phase)
        stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target)
    assert sorted(lines(target)[1:]) == sorted([str(k), str(v), g] for b in batches()[:2] for k, v, g in b)
    assert lines(target)[0] == ["k", "v", "g"]


def test_compact_log_of_the_sink(spark, tmp_path):
    """Spark folds the sink's log every ten batches."""
    for i in range(13):
        add(spark, f"{tmp_path}/in", [(i, i, "a")])
    target = tmp_path / "out.csv"
    stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target)
    for i in range(13, 25):
        add(spark, f"{tmp_path}/in", [(i, i, "a")])
    stream_to_csv(source(spark, f"{tmp_path}/in"), tmp_path / "s", target)
    assert sorted(int(r[0]) for r in lines(target)[1:]) == list(range(25))
