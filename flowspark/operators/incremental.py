"""Incremental loads: rows whose keys the target lacks are appended.

The batch is evaluated once: one row of each key goes to a folder that readers don't see, and its counts are made on the
way. Of the target only key columns are read, and of these only rows that the batch's keys may meet (see keyfilter). Files are moved
into the target when all is known, so that a batch with null keys, or a job that fails, leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import RecipeError
from ..observed import result_of
from ..sinks.commit import data_files, has_data, move_files
from ..sinks.parquet import OutputConfig, output_metrics, write_files
from ..sinks.store import remove
from ..types import check_evolution, column, require_columns
from .keyfilter import pruned
from .relational import new_rows

COPIES = "_flow_copias"


@dataclass(frozen=True)
class IncrementalConfig:
    active: bool = False
    keys: tuple[str, ...] = ()

    @classmethod
    def of(cls, doc: dict) -> IncrementalConfig:
        if str(doc.get("duplicados", "ignorar")) != "ignorar":
            raise RecipeError("incremental.duplicados solo admite 'ignorar'", "RECIPE_INVALID")
        out = cls(bool(doc.get("activo", False)), tuple(doc.get("claves") or ()))
        if out.active and not out.keys:
            raise RecipeError("incremental necesita claves", "RECIPE_INVALID")
        return out


def first_of_key(df: DataFrame, keys: list[str], copies: str | None = None) -> DataFrame:
    """One row for each key, the least by all other columns, so that a rerun keeps the same one; copies: a column for how many rows the key has.

    An aggregation, so that a key with very many rows shrinks before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in rest if df.schema[c].dataType.typeName() not in ("map", "variant")]
    made = [F.min_by(F.struct(*map(column, rest)), F.struct(*map(column, ordered)) if ordered else F.lit(1)).alias("_flow_rest")] if rest else []
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not made and not counted:
        return df.dropDuplicates(keys)
    found = df.groupBy(*map(column, keys)).agg(*made, *counted)
    return found.select(*[column(c) if c in keys else F.col("_flow_rest")[c].alias(c) for c in df.columns], *([column(copies)] if copies else []))


def staging_of(path: str) -> str:
    """A new folder below the target, so that moving its files is a matter of names; readers don't see it."""
    return f"{path.rstrip('/')}/_lote-{uuid.uuid4().hex}"


def existing_target(spark: SparkSession, path: str, batch: DataFrame, output: OutputConfig) -> DataFrame:
    """The target, whose columns must be those of the batch or fewer. Folders' names have no types, so that the columns in them get the batch's."""
    old = spark.read.option("mergeSchema", "true").parquet(path)
    plain = lambda df: df.select(*[column(c) for c in df.columns if c not in output.partition_by])
    check_evolution(plain(old).schema, plain(batch).schema)
    return old.withColumns({c: column(c).cast(batch.schema[c].dataType) for c in output.partition_by if c in old.columns})


def stage_batch(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], output: OutputConfig, folder: str, verify: Callable[[], None] = lambda: None) -> dict:
    """Write the batch's new rows to folder; returns the counts. Rows of the target are told apart by keys only. verify: called when the batch has been read."""
    require_columns(batch, keys, "incremental")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | column(k).isNull()
    counts = [F.count(F.lit(1)).alias("keys"), F.sum(COPIES).alias("rows"), F.max(null_key.cast("int")).alias("nulls")]
    there = has_data(spark, path)
    seen = Observation()
    unique = first_of_key(batch, keys, COPIES)
    if there:
        old = existing_target(spark, path, batch, output)
        require_columns(old, keys, "incremental")
        draft = f"{folder}/_unicas"
        unique.observe(seen, *counts).write.parquet(draft)
    else:
        write_files(unique, folder, output, "error", lambda df: df.observe(seen, *counts).drop(COPIES))
    found = result_of(seen) or spark.read.schema(unique.schema).parquet(draft if there else folder).agg(*counts).first().asDict()
    verify()
    if found["nulls"]:
        raise RecipeError(f"Hay claves nulas en {keys}", "KEY_NULL")
    told = {"entrada": found["rows"] or 0, "unicas": found["keys"], "nuevas": found["keys"], "antes": 0}
    if there:
        told["antes"] = old.count()  # from the files' footers
        if found["keys"]:
            drafted = spark.read.schema(unique.schema).parquet(draft)
            fresh, added = new_rows(drafted.drop(COPIES), pruned(old, drafted.select(*map(column, keys)), keys, found["keys"]), keys), Observation()
            write_files(fresh.select(*map(column, batch.columns)), folder, output, "append", lambda df: df.observe(added, F.count(F.lit(1)).alias("n")))
            told["nuevas"] = (result_of(added) or {"n": spark.read.parquet(folder).count() if data_files(spark, folder) else 0})["n"]
        remove(spark, draft)
    if not told["nuevas"]:
        remove(spark, folder)
    return told


def metrics_of(told: dict, keys: list[str]) -> dict:
    return {
        "modo_carga": "incremental",
        "claves_deduplicacion": keys,
        "total_registros_entrada": told["entrada"],
        "total_registros_unicos_lote": told["unicas"],
        "total_registros_nuevos": told["nuevas"],
        "total_registros_duplicados": told["entrada"] - told["nuevas"],
        "total_registros_antes": told["antes"],
        "total_registros": told["antes"] + told["nuevas"],
    }


def run_incremental(spark: SparkSession, batch: DataFrame, path: str, config: IncrementalConfig, output: OutputConfig, verify: Callable[[], None] = lambda: None) -> dict:
    """verify: called when the batch has been read; raises if nothing is to be published."""
    keys = list(config.keys)
    require_columns(batch, keys, "incremental")
    if output.mode != "append":
        raise RecipeError("La carga incremental necesita modo append", "RECIPE_INVALID")
    folder = staging_of(path)
    try:
        told = stage_batch(spark, batch, path, keys, output, folder, verify)
        if not told["entrada"]:
            raise RecipeError("El lote está vacío", "BATCH_EMPTY")
        if told["nuevas"]:
            move_files(spark, folder, path, data_files(spark, folder))
    finally:
        remove(spark, folder)
    return output_metrics(spark, path) | metrics_of(told, keys)


