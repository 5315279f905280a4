"""Incremental loads of a stream: each micro-batch adds the rows whose keys the target lacks, exactly once.

A batch's new rows are staged, told in a log and moved into the target (see sinks.commit). The log goes by the query's id and the batch's number, so that a
batch that Spark gives again, because a run stopped before its own checkpoint knew of it, is finished or passed over. A stream
that begins anew, with another checkpoint, has a log of its own; its rows are told from those of the target by their keys, as in any load.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame

from ..errors import FlowError, RecipeError
from ..operators.incremental import IncrementalConfig, metrics_of, stage_batch
from ..sinks.commit import CommitLog, Phase, commit_batch, read_text
from ..sinks.parquet import OutputConfig
from ..types import require_columns


def stream_incremental(
    df: DataFrame, path: str, config: IncrementalConfig, output: OutputConfig, state: str, timeout: int | None = None, phase: Phase = lambda _name, _batch: None
) -> list[dict]:
    """Load what the source has now; returns the metrics of the batches of this run, and those of batches that an earlier run had not finished.

    state: a folder of this stream in the shared store, for the checkpoint and the log. phase: called when a phase of a batch has ended.
    """
    if not df.isStreaming:
        raise FlowError("Se esperaba un DataFrame de streaming", "STREAM_REQUIRED")
    keys = list(config.keys)
    require_columns(df, keys, "incremental")
    if output.mode != "append":
        raise RecipeError("La carga incremental necesita modo append", "RECIPE_INVALID")
    state, path, done, failed = state.rstrip("/"), path.rstrip("/"), [], []

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            name = json.loads(read_text(spark, f"{state}/checkpoint/metadata"))["id"]
            folder = f"{path}/_lote-{hashlib.sha256(name.encode()).hexdigest()[:12]}-{number}"
            told = commit_batch(CommitLog(spark, f"{state}/commits/{name}"), number, path, folder, lambda to: stage_batch(spark, batch, path, keys, output, to), phase)
        except Exception as e:
            failed.append(e)
            raise
        if told is not None:
            done.append({"lote": number} | metrics_of(told, keys))

    query = df.writeStream.foreachBatch(load).option("checkpointLocation", f"{state}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    try:
        ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() is None
    except Exception as e:
        if failed and isinstance(failed[0], FlowError):
            raise failed[0] from e
        raise FlowError(f"El streaming falló: {e}", "STREAM_FAILED") from e
    if not ended:
        query.stop()
        raise FlowError("El streaming no terminó a tiempo", "STREAM_TIMEOUT")
    return done
