"""The verified Parquet sink."""

from __future__ import annotations

import contextlib
import shutil
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..errors import RecipeError
from ..types import column, require_columns
from .layout import planned
from .store import hadoop_path, remove

LOCAL_ROOT = "/srv/flowspark/salida"
MODES = {"append", "overwrite", "error", "errorifexists", "ignore"}
#: Folders that a task writes side by side, with a row group in memory for each; rows of further folders are sorted by folder, which spills.
OPEN_FOLDERS = 8
CONCURRENT = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class OutputConfig:
    format: str = "parquet"
    mode: str = "error"
    compression: str = "snappy"
    partitions: int | None = None
    partition_keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    local_root: str = LOCAL_ROOT
    file_mb: float | None = None

    @classmethod
    def of(cls, doc: dict) -> OutputConfig:
        out = cls(
            str(doc.get("formato", "parquet")).lower(),
            str(doc.get("modo", "error")).lower(),
            str(doc.get("compresion", "snappy")).lower(),
            int(doc["numero_particiones"]) if doc.get("numero_particiones") is not None else None,
            tuple(doc.get("columnas_reparticion") or ()),
            tuple(doc.get("particionar_por") or ()),
            str(doc.get("raiz_local", LOCAL_ROOT)),
            float(doc["tamano_archivo_mb"]) if doc.get("tamano_archivo_mb") is not None else None,
        )
        if out.format != "parquet":
            raise RecipeError(f"Formato de salida no soportado: {out.format}", "OUTPUT_FORMAT")
        if out.mode not in MODES or out.partitions is not None and out.partitions < 1 or out.file_mb is not None and (out.file_mb <= 0 or out.partitions):
            raise RecipeError("Salida inválida", "RECIPE_INVALID")
        return out


def output_metrics(spark: SparkSession, path: str) -> dict:
    """Checks _SUCCESS and the Parquet files in any store that Hadoop knows."""
    where, files = hadoop_path(spark, path)
    if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(where, "_SUCCESS")):
        raise RecipeError(f"La salida no tiene _SUCCESS: {path}", "OUTPUT_INCOMPLETE")
    found, count, size = files.listFiles(where, True), 0, 0
    while found.hasNext():
        one = found.next()
        if one.getPath().getName().endswith(".parquet"):
            count, size = count + 1, size + one.getLen()
    if not count or not size:
        raise RecipeError(f"La salida no tiene archivos Parquet: {path}", "OUTPUT_EMPTY")
    return {"archivo_success": True, "cantidad_archivos_parquet": count, "bytes_parquet": size, "esquema_almacenamiento": where.toUri().getScheme() or "file"}


def local_target(path: str, config: OutputConfig) -> Path | None:
    """The local folder that is to be overwritten, which has to be below the configured root; None for other modes and stores."""
    if config.mode != "overwrite" or "://" in path and not path.startswith("file://"):
        return None
    target, root = Path(path.removeprefix("file://")).resolve(), Path(config.local_root).resolve()
    if target == root or not target.is_relative_to(root):
        raise RecipeError(f"Solo se sobrescribe bajo {root}: {target}", "OVERWRITE_NOT_ALLOWED")
    return target


def prepare_local(path: str, config: OutputConfig) -> str:
    """The mode to write with, after an old local folder has gone."""
    target = local_target(path, config)
    if target is None:
        return config.mode
    if target.exists():
        shutil.rmtree(target)
    target.mkdir(parents=True, mode=0o2770)
    return "append"


@contextlib.contextmanager
def folders_side_by_side(spark: SparkSession):
    """Tasks keep a file open for each folder instead of sorting all their rows by folder, which takes memory as the rows do."""
    before = spark.conf.get(CONCURRENT)
    if int(before) < OPEN_FOLDERS:
        spark.conf.set(CONCURRENT, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(CONCURRENT, before)


def write_files(df: DataFrame, path: str, config: OutputConfig, mode: str, last: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """last: applied when rows are dealt out, so that what it observes is made by the tasks that write, once for each file."""
    spark, tables = df.sparkSession, []
    if config.file_mb:
        df, tables = planned(df, config.partition_by, config.file_mb, config.compression)
    elif config.partitions:
        df = df.repartition(config.partitions, *map(column, config.partition_keys))
    writer = last(df).write.mode(mode)
    if config.compression != "none":
        writer = writer.option("compression", config.compression)
    if config.partition_by:
        writer = writer.partitionBy(*config.partition_by)
    try:
        with folders_side_by_side(spark):
            writer.parquet(path)
    finally:
        for table in tables:
            remove(spark, table)


def write(spark: SparkSession, df: DataFrame, path: str, config: OutputConfig, mode: str | None = None, last: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict:
    require_columns(df, [*config.partition_keys, *config.partition_by], "salida")
    write_files(df, path, config, mode or prepare_local(path, config), last)
    return output_metrics(spark, path)
