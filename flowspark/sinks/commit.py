"""Commits to a folder of data files in two phases, in any store that Hadoop knows.

Rows are first written to a folder below the target whose name begins with an underscore, so that readers don't see it. What is to be published is then
told in a log (prepared), the files are moved to their places, and the log tells that too (committed). Every step may be
repeated: a run that stops anywhere is finished, or begun anew, by the next one, and never shows a part twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..errors import FlowError, RecipeError
from ..types import require_columns
from .parquet import OutputConfig, local_target, output_metrics, write_files
from .store import exists, hadoop_path, names_in, remove

Phase = Callable[[str, int], None]


def hidden(name: str) -> bool:
    """Whether readers leave a file or folder out."""
    return name.startswith(("_", ".")) and "=" not in name


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    where, files = hadoop_path(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file is there with all of its text or not at all."""
    where, files = hadoop_path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{where.getName()}-{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not files.rename(draft, where):
        files.delete(draft, False)
        if not files.exists(where):
            raise FlowError(f"No se pudo escribir {where.getName()}", "COMMIT_FAILED")


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The data files below a folder, by their names relative to it, sorted."""
    where, files = hadoop_path(spark, folder)
    if not files.exists(where):
        return []
    found, out = files.listFiles(where, True), []
    while found.hasNext():
        name = where.toUri().relativize(found.next().getPath().toUri()).getPath()
        if name.startswith("/"):  # listed by another address than asked for
            name = name.split(f"/{where.getName()}/", 1)[1]
        if not any(hidden(part) for part in name.split("/")):
            out.append(name)
    return sorted(out)


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether there is any data file below a folder; the listing ends with the first."""
    where, files = hadoop_path(spark, folder)
    if not files.exists(where):
        return False
    root = [where]
    while root:
        for one in files.listStatus(root.pop()):
            if hidden(one.getPath().getName()):
                continue
            if one.isFile():
                return True
            root.append(one.getPath())
    return False


def move_files(spark: SparkSession, folder: str, target: str, names: list[str]) -> None:
    """Files of folder to the same places in target. One that is there already was moved before a stop."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    root, files = hadoop_path(spark, target)
    for name in names:
        source, to = to_path(f"{folder}/{name}"), to_path(f"{target}/{name}")
        if files.exists(source):
            files.mkdirs(to.getParent())
            if not files.rename(source, to):
                raise FlowError(f"No se pudo mover {name}", "COMMIT_FAILED")
        elif not files.exists(to):
            raise FlowError(f"Falta {name}", "COMMIT_FAILED")
    files.create(to_path(root, "_SUCCESS"), True).close()


@dataclass(frozen=True)
class CommitLog:
    """What is known of numbered batches: prepared (their files and metrics) and committed."""

    spark: SparkSession
    root: str

    def path(self, batch: int, phase: str) -> str:
        return f"{self.root}/{batch:012}.{phase}.json"

    def told(self, batch: int, phase: str) -> dict | None:
        text = read_text(self.spark, self.path(batch, phase))
        return None if text is None else json.loads(text)

    def tell(self, batch: int, phase: str, doc: dict) -> None:
        write_text(self.spark, self.path(batch, phase), json.dumps(doc, ensure_ascii=False, default=str))

    def committed(self) -> list[dict]:
        """The documents of all committed batches, in their order."""
        return [json.loads(read_text(self.spark, f"{self.root}/{n}")) for n in names_in(self.spark, self.root) if n.endswith(".committed.json")]


def commit_batch(log: CommitLog, batch: int, target: str, folder: str, stage: Callable[[str], dict], phase: Phase = lambda _name, _batch: None) -> dict | None:
    """Publish a batch exactly once. stage(folder) writes its rows there and returns metrics; None: it had been committed before.

    phase is called with the name of each phase that has ended: staged, prepared, moved, committed.
    """
    if log.told(batch, "committed") is not None:
        return None
    plan = log.told(batch, "prepared")
    if plan is None:
        remove(log.spark, folder)
        metrics = stage(folder)
        phase("staged", batch)
        plan = {"lote": batch, "archivos": data_files(log.spark, folder), "metricas": metrics}
        log.tell(batch, "prepared", plan)
        phase("prepared", batch)
    if plan["archivos"]:
        move_files(log.spark, folder, target, plan["archivos"])
    phase("moved", batch)
    remove(log.spark, folder)
    log.tell(batch, "committed", plan)
    phase("committed", batch)
    return plan["metricas"]


def write_verified(
    spark: SparkSession, df: DataFrame, path: str, config: OutputConfig, verify: Callable[[], None], last: Callable[[DataFrame], DataFrame] = lambda df: df
) -> dict:
    """The Parquet sink for rows that are judged while they are written: verify() raises if the target is to stay as it is."""
    require_columns(df, [*config.partition_keys, *config.partition_by], "salida")
    old = local_target(path, config)
    if config.mode in ("error", "errorifexists", "ignore") and exists(spark, path):
        if config.mode == "ignore":
            return output_metrics(spark, path)
        raise RecipeError(f"La salida ya existe: {path}", "OUTPUT_EXISTS")
    if old is not None and not old.exists():
        old.mkdir(parents=True, mode=0o2770)
    folder = f"{path.rstrip('/')}/_lote-{uuid.uuid4().hex}"
    had = exists(spark, path)
    try:
        write_files(df, folder, config, "error", last)
        verify()
        if config.mode == "overwrite":
            for name in names_in(spark, path):
                if name != folder.rsplit("/", 1)[-1]:
                    remove(spark, f"{path}/{name}")
        move_files(spark, folder, path, data_files(spark, folder))
    finally:
        remove(spark, folder)
        if not had and not names_in(spark, path):
            remove(spark, path)
    return output_metrics(spark, path)
