"""Recipes: one input, a list of steps, one verified Parquet output."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .errors import RecipeError
from .operators.incremental import IncrementalConfig, run_incremental
from .operators.steps import apply_steps, validate_step
from .observed import Watch, result_of
from .sinks.commit import write_verified
from .sinks.parquet import OutputConfig, write
from .sources.reader import InputConfig, read, resolve_schema
from .types import as_bool

DEFAULT_NAME = "receta"


@dataclass(frozen=True)
class Recipe:
    name: str
    version: str | None
    input: InputConfig
    steps: tuple[dict, ...]
    incremental: IncrementalConfig
    output: OutputConfig
    count: bool
    log_level: str
    shuffle_partitions: int | None


def load_recipe(source: str) -> Recipe:
    """A recipe from a JSON text (it begins with a brace) or a file; everything is checked before Spark starts."""
    text = source.strip()
    if not text.startswith("{"):
        if not Path(source).is_file():
            raise RecipeError(f"No existe la receta: {source}", "RECIPE_NOT_FOUND")
        text = Path(source).read_text("utf-8")
    try:
        doc = json.loads(text)
    except ValueError as e:
        raise RecipeError(f"La receta no es JSON: {e}", "RECIPE_INVALID") from e
    if not isinstance(doc, dict) or not isinstance(doc.get("entrada", {}), dict):
        raise RecipeError("La receta debe ser un objeto con entrada", "RECIPE_INVALID")
    if not isinstance(doc.get("salida"), dict):
        raise RecipeError("La receta necesita salida", "RECIPE_INVALID")
    steps = doc.get("pasos") or []
    for i, one in enumerate(steps, 1):
        validate_step(one, i)
    session = doc.get("spark") or {}
    return Recipe(
        doc.get("nombre", DEFAULT_NAME),
        doc.get("version"),
        InputConfig.of(doc.get("entrada") or {}),
        tuple(steps),
        IncrementalConfig.of(doc.get("incremental") or {}),
        OutputConfig.of(doc["salida"]),
        as_bool((doc.get("auditoria") or {}).get("contar_registros", False)),
        str(session.get("nivel_log", "WARN")),
        session.get("shuffle_partitions"),
    )


def transform(recipe: Recipe, df: DataFrame, event: Callable[[str], None] = lambda _: None) -> DataFrame:
    return apply_steps(df, list(recipe.steps), event)


def shape(df: DataFrame, what: str) -> dict:
    return {f"columnas_{what}": df.columns, f"esquema_{what}": df.schema.jsonValue(), f"esquema_{what}_simple": df.schema.simpleString()}


def full_load(spark: SparkSession, out: DataFrame, target: str, recipe: Recipe, watch: Watch) -> dict:
    """One job: rows are counted by the tasks that write them, and checks of the input are made on the way."""
    rows = Observation()
    counted = (lambda df: df.observe(rows, F.count(F.lit(1)).alias("n"))) if recipe.count else (lambda df: df)
    if watch.pending:
        metrics = write_verified(spark, out, target, recipe.output, watch.verify, counted)
    else:
        metrics = write(spark, out, target, recipe.output, last=counted)
    if not recipe.count:
        return metrics | {"total_registros": None}
    found = result_of(rows)
    return metrics | {"total_registros": spark.read.parquet(target).count() if found is None else found["n"]}


def run_recipe(spark: SparkSession, recipe: Recipe, source: str, target: str, schema_text: str | None, run_id: str, event: Callable[[str], None] = print) -> dict:
    """The result document; the output is written and verified."""
    event(f"EJECUCION_INICIO={run_id}")
    event(f"MODO_ESQUEMA_ENTRADA={recipe.input.mode}")
    schema = resolve_schema(recipe.input, schema_text)
    if recipe.input.mode == "inferir" and schema_text:
        event("SCHEMA_SPEC_IGNORADO=true")
    if schema is not None:
        event(f"ESQUEMA_ENTRADA_DECLARADO={schema.simpleString()}")
    watch = Watch()
    df = read(spark, source, schema, recipe.input, watch)
    if recipe.input.mode == "inferir":
        event(f"COLUMNAS_NORMALIZADAS={json.dumps(df.columns, ensure_ascii=False)}")
        if recipe.input.forced:
            event(f"TIPOS_FORZADOS_ENTRADA={json.dumps(recipe.input.forced, ensure_ascii=False)}")
    event(f"ESQUEMA_ENTRADA_REAL={df.schema.simpleString()}")
    event("LECTURA_COMPLETADA=true")
    out = transform(recipe, df, event)
    event(f"ESCRITURA_INICIO={target}")
    if recipe.incremental.active:
        metrics = run_incremental(spark, out, target, recipe.incremental, recipe.output, watch.verify)
        event(f"INCREMENTAL_RESULTADO={json.dumps(metrics, ensure_ascii=False)}")
    else:
        metrics = full_load(spark, out, target, recipe, watch)
    event("ESCRITURA_FIN=true")
    event(f"SALIDA_VALIDADA={metrics['cantidad_archivos_parquet']}")
    return {
        "estado": "COMPLETADO", "ejecucion_id": run_id, "receta": recipe.name, "version_receta": recipe.version, "entrada": source, "salida": target,
        "modo_esquema_entrada": recipe.input.mode, **shape(df, "entrada"), **shape(out, "salida"), **metrics,
    }
