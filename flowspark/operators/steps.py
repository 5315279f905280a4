"""Recipe steps: each takes a DataFrame and its settings and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import RecipeError
from ..types import column, require_columns, spark_type

Step = Callable[[DataFrame, dict], DataFrame]
STEPS: dict[str, tuple[Step, tuple[str, ...]]] = {}


def step(name: str, *required: str) -> Callable[[Step], Step]:
    """Register a step; required: settings that must be there."""

    def add(f: Step) -> Step:
        STEPS[name] = (f, required)
        return f

    return add


def validate_step(doc: dict, number: int) -> None:
    kind = doc.get("tipo") if isinstance(doc, dict) else None
    if kind not in STEPS:
        raise RecipeError(f"Paso {number}: tipo desconocido {kind!r}; válidos: {sorted(STEPS)}", "STEP_UNKNOWN")
    missing = [k for k in STEPS[kind][1] if doc.get(k) is None]
    if missing:
        raise RecipeError(f"Paso {number} ({kind}): faltan {missing}", "STEP_INVALID")
    if kind == "reparticionar" and int(doc["cantidad"]) < 1:
        raise RecipeError(f"Paso {number}: cantidad debe ser 1 o más", "STEP_INVALID")
    if kind == "agrupar" and not doc["metricas"]:
        raise RecipeError(f"Paso {number}: agrupar necesita métricas", "STEP_INVALID")


def apply_steps(df: DataFrame, docs: list[dict], event: Callable[[str], None] = lambda _: None) -> DataFrame:
    for i, doc in enumerate(docs, 1):
        event(f"PASO_INICIO={i}:{doc['tipo']}")
        df = STEPS[doc["tipo"]][0](df, doc)
        event(f"PASO_FIN={i}:{doc['tipo']}")
    return df


@step("seleccionar_columnas", "columnas")
def select_columns(df: DataFrame, doc: dict) -> DataFrame:
    require_columns(df, doc["columnas"], "seleccionar_columnas")
    return df.select(*map(column, doc["columnas"]))


@step("eliminar_columnas", "columnas")
def drop_columns(df: DataFrame, doc: dict) -> DataFrame:
    require_columns(df, doc["columnas"], "eliminar_columnas")
    return df.drop(*doc["columnas"])


@step("renombrar_columna", "origen", "destino")
def rename_column(df: DataFrame, doc: dict) -> DataFrame:
    require_columns(df, [doc["origen"]], "renombrar_columna")
    if doc["destino"] in df.columns:
        raise RecipeError(f"renombrar_columna: ya existe {doc['destino']}", "COLUMN_EXISTS")
    return df.withColumnRenamed(doc["origen"], doc["destino"])


@step("crear_columna", "nombre", "expresion")
def create_column(df: DataFrame, doc: dict) -> DataFrame:
    return df.withColumn(doc["nombre"], F.expr(doc["expresion"]))


@step("convertir_tipo", "columna", "destino")
def convert_type(df: DataFrame, doc: dict) -> DataFrame:
    require_columns(df, [doc["columna"]], "convertir_tipo")
    source, target, form = column(doc["columna"]), doc["destino"].strip().lower(), doc.get("formato")
    if target in ("date", "fecha"):
        new = F.to_date(source, form) if form else F.to_date(source)
    elif target == "timestamp":
        new = F.to_timestamp(source, form) if form else F.to_timestamp(source)
    else:
        new = source.cast(spark_type(target))
    return df.withColumn(doc["columna"], new)


@step("filtrar", "expresion")
def filter_rows(df: DataFrame, doc: dict) -> DataFrame:
    return df.filter(F.expr(doc["expresion"]))


@step("rellenar_nulos", "valores")
def fill_nulls(df: DataFrame, doc: dict) -> DataFrame:
    require_columns(df, list(doc["valores"]), "rellenar_nulos")
    return df.fillna(doc["valores"])


TEXT_STEPS = {"trim": F.trim, "lower": F.lower, "upper": F.upper}


@step("normalizar_texto", "columnas", "operaciones")
def normalise_text(df: DataFrame, doc: dict) -> DataFrame:
    require_columns(df, doc["columnas"], "normalizar_texto")
    unknown = [o for o in doc["operaciones"] if o not in TEXT_STEPS]
    if unknown:
        raise RecipeError(f"normalizar_texto: operaciones desconocidas {unknown}", "STEP_INVALID")

    def new(c: str) -> Column:
        out = column(c)
        for o in doc["operaciones"]:
            out = TEXT_STEPS[o](out)
        return out

    return df.withColumns({c: new(c) for c in doc["columnas"]})


@step("eliminar_duplicados")
def drop_duplicates(df: DataFrame, doc: dict) -> DataFrame:
    """One row for each key (any of them); without columns the whole row is the key."""
    keys = doc.get("columnas") or []
    require_columns(df, keys, "eliminar_duplicados")
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()


METRICS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.countDistinct,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
}


@step("agrupar", "metricas")
def group(df: DataFrame, doc: dict) -> DataFrame:
    keys = doc.get("columnas") or []
    require_columns(df, keys, "agrupar")
    made = []
    for m in doc["metricas"]:
        kind, source = str(m.get("operacion", "")).lower(), m.get("columna", "*")
        if kind not in METRICS or not m.get("alias"):
            raise RecipeError(f"agrupar: métrica inválida {m}", "METRIC_INVALID")
        if source == "*":
            if kind != "count":
                raise RecipeError(f"agrupar: {kind} necesita una columna", "METRIC_INVALID")
            made.append(F.count(F.lit(1)).alias(m["alias"]))
        else:
            require_columns(df, [source], "agrupar")
            made.append(METRICS[kind](column(source)).alias(m["alias"]))
    if not made:
        raise RecipeError("agrupar: faltan métricas", "METRIC_INVALID")
    return df.groupBy(*map(column, keys)).agg(*made)


@step("reparticionar", "cantidad")
def repartition(df: DataFrame, doc: dict) -> DataFrame:
    keys = doc.get("columnas") or []
    require_columns(df, keys, "reparticionar")
    return df.repartition(int(doc["cantidad"]), *map(column, keys))
