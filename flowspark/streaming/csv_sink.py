"""A streaming DataFrame to one CSV file in any store that Hadoop knows: each run adds what is new to the file.

The stream writes parts, one set for each batch; the sink's own log tells which parts count. A run that finds parts after the last published batch puts
the file's bytes and theirs together under another name and moves that into place. What is about to be published is told in the
state folder first, so that a run that stops between moving and telling is known to the next one by the file's digest.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..errors import FlowError
from ..sinks.commit import read_text, write_text
from ..sinks.publish import Manifest, head_of, now
from ..sinks.store import copy_into, digest_of, names_in, replace, store_of
from ..types import column

#: Rows are written as they are; the header is put in front once.
OPTIONS = {"header": "false", "emptyValue": "", "nullValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def written_parts(spark: SparkSession, folder: str) -> list[str]:
    """The files of finished batches, batch by batch and in the order of their partitions; later runs find the same list with more at its end.

    A compact log has the files of all batches before it, in their order.
    """
    logs = sorted((int(n.split(".")[0]), n) for n in names_in(spark, f"{folder}/_spark_metadata") if n.split(".")[0].isdigit())
    compact = max((i for i, (_, n) in enumerate(logs) if n.endswith(".compact")), default=0)
    out: dict[str, None] = {}
    for _, name in logs[compact:]:
        told = [unquote(json.loads(line)["path"]) for line in read_text(spark, f"{folder}/_spark_metadata/{name}").splitlines()[1:]]
        out |= dict.fromkeys(told if name.endswith(".compact") else sorted(told, key=lambda p: p.rsplit("/", 1)[-1]))
    return list(out)


def published(spark: SparkSession, state: str) -> dict | None:
    """The last thing told of the file: partes (how many parts it holds), ultima (the last one), from (digest before, null for none), bytes and sha256 (after)."""
    names = [n for n in names_in(spark, f"{state}/published") if n.endswith(".json")]
    return json.loads(read_text(spark, f"{state}/published/{names[-1]}")) if names else None


def add_to_file(spark: SparkSession, state: str, target: str, head: bytes, phase: Callable[[str], None]) -> dict:
    """Bring the file up to date with the finished batches."""
    told, there = published(spark, state), digest_of(spark, target)
    if told and there and there[1] != told["sha256"]:
        if there[1] != told["from"]:
            raise FlowError(f"El destino existe con otro contenido: {target.rsplit('/', 1)[-1]}", "PUBLISH_CONFLICT")
        told = told["before"]  # the run before stopped ahead of the move
    elif told and not there:
        told = told["before"] if told["from"] is None else None
    parts = written_parts(spark, f"{state}/parts")
    if told and told["ultima"] and told["ultima"] not in parts:
        raise FlowError("El registro del streaming no conoce lo publicado", "STREAM_LOG_LOST")
    new = parts[parts.index(told["ultima"]) + 1 :] if told and told["ultima"] else parts
    if told and not new:
        return told
    partial = f"{target}.partial"
    where, files = store_of(spark, partial)
    out = files.create(where, True)
    try:
        if told:
            copy_into(spark, out, target)
        else:
            out.write(bytearray(head))
        for part in new:
            copy_into(spark, out, part)
    finally:
        out.close()
    size, sha = digest_of(spark, partial)
    if there and not told and there[1] != sha:
        files.delete(where, False)
        raise FlowError(f"El destino existe con otro contenido: {target.rsplit('/', 1)[-1]}", "PUBLISH_CONFLICT")
    doc = {"bytes": size, "sha256": sha, "partes": len(parts), "ultima": parts[-1] if parts else None, "from": there[1] if there else None}
    write_text(spark, f"{state}/published/{len(parts):012}-{sha[:12]}.json", json.dumps(doc | {"before": told and {k: v for k, v in told.items() if k != "before"}}))
    phase("told")
    replace(spark, partial, target)
    phase("moved")
    return doc


def stream_to_csv(df: DataFrame, state: str | Path, target: str | Path, header: bool = True, timeout: int | None = None, phase: Callable[[str], None] = lambda _name: None) -> Manifest:
    """Reads what the source has, and adds it to the file.

    state: a folder that driver and executors share, which belongs to this stream (parts, checkpoint, what was published); target: the file.
    Both are addresses of any file system or local paths. Without a timeout (seconds) a stream of any size runs to its end. Another content than
    what this stream has published is never replaced.
    """
    if not df.isStreaming:
        raise FlowError("Se esperaba un DataFrame de streaming", "STREAM_REQUIRED")
    spark, names = df.sparkSession, df.columns
    state, target = (f"file://{x.resolve()}" if isinstance(x, Path) else x.rstrip("/") for x in (state, target))
    query = (
        df.select(*[column(c).cast("string").alias(c) for c in names]).writeStream.format("csv").options(**OPTIONS)
        .option("checkpointLocation", f"{state}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{state}/parts")
    )
    try:
        ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() is None
    except Exception as e:
        raise FlowError(f"El streaming falló: {e}", "STREAM_FAILED") from e
    if not ended:
        query.stop()
        raise FlowError("El streaming no terminó a tiempo", "STREAM_TIMEOUT")
    doc = add_to_file(spark, state, target, head_of(names) if header else b"", phase)
    return Manifest(target.rsplit("/", 1)[-1], doc["bytes"], doc["sha256"], None, "PUBLICADO", now())
