"""Reading: any Spark format with a declared or inferred schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..errors import RecipeError
from ..observed import Watch
from ..types import as_bool, forced_types, normalise_columns, parse_schema, void_to_string

STRICT_WORDS = {"estricto", "strict", "schema"}
INFER_WORDS = {"inferir", "infer", "inferido", "dinamico", "dinámico"}


@dataclass(frozen=True)
class InputConfig:
    format: str = "csv"
    mode: str = "estricto"
    options: dict = field(default_factory=dict)
    infer_types: bool = True
    normalise_names: bool = True
    forced: dict = field(default_factory=dict)

    @classmethod
    def of(cls, doc: dict) -> InputConfig:
        mode = str(doc.get("modo_esquema", "estricto")).strip().lower()
        if mode not in STRICT_WORDS | INFER_WORDS:
            raise RecipeError(f"modo_esquema inválido: {mode}", "RECIPE_INVALID")
        return cls(
            str(doc.get("formato", "csv")).lower(),
            "estricto" if mode in STRICT_WORDS else "inferir",
            dict(doc.get("opciones") or {}),
            as_bool(doc.get("inferir_tipos", True)),
            as_bool(doc.get("normalizar_nombres_columnas", True)),
            dict(doc.get("tipos_forzados") or {}),
        )


def option_strings(options: dict) -> dict[str, str]:
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if v is not None}


def resolve_schema(config: InputConfig, text: str | None) -> StructType | None:
    if config.mode == "inferir":
        return None
    if not text:
        raise RecipeError("El modo estricto necesita --esquema", "SCHEMA_REQUIRED")
    return parse_schema(text)


def read(spark: SparkSession, path: str, schema: StructType | None, config: InputConfig, watch: Watch | None = None) -> DataFrame:
    """watch: checks of forced types wait for the job that reads the result."""
    options = option_strings(config.options)
    if config.mode == "inferir":
        if schema is not None:
            raise RecipeError("El modo inferir no admite esquema", "SCHEMA_UNEXPECTED")
        if config.format == "csv":
            if options.setdefault("header", "true") != "true":
                raise RecipeError("El modo inferir necesita encabezado", "HEADER_REQUIRED")
            options.setdefault("inferSchema", str(config.infer_types).lower())
            options.setdefault("mode", "FAILFAST")
        df = spark.read.format(config.format).options(**options).load(path)
        return forced_types(void_to_string(normalise_columns(df, config.normalise_names)), config.forced, watch)
    if schema is None:
        raise RecipeError("El modo estricto necesita un esquema", "SCHEMA_REQUIRED")
    return spark.read.format(config.format).options(**options).schema(schema).load(path)


def read_csv(spark: SparkSession, path: str, header: bool = True, separator: str = ",") -> DataFrame:
    """Dataflow CSV: header and types from the file."""
    return spark.read.option("header", str(header).lower()).option("sep", separator).option("inferSchema", "true").csv(path)
