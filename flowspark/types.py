"""Type words, schema strings, column names."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import RecipeError
from .observed import Watch

NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
DECIMAL = re.compile(r"decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)")
#: The type words that recipes may use.
TYPE_WORDS = {
    "string": T.StringType, "texto": T.StringType,
    "int": T.IntegerType, "integer": T.IntegerType, "entero": T.IntegerType,
    "long": T.LongType, "bigint": T.LongType,
    "double": T.DoubleType, "float": T.FloatType,
    "boolean": T.BooleanType, "bool": T.BooleanType,
    "date": T.DateType, "fecha": T.DateType,
    "timestamp": T.TimestampType,
}
#: The words for true and false that recipes may use.
TRUE_WORDS = {"1", "true", "si", "sí", "yes"}
FALSE_WORDS = {"0", "false", "no"}


def spark_type(word: str) -> T.DataType:
    key = word.strip().lower()
    if key in TYPE_WORDS:
        return TYPE_WORDS[key]()
    if m := DECIMAL.fullmatch(key):
        precision, scale = int(m[1]), int(m[2])
        if 1 <= precision <= 38 and scale <= precision:
            return T.DecimalType(precision, scale)
    raise RecipeError(f"Tipo no soportado: {word}", "TYPE_UNSUPPORTED")


def parse_schema(text: str) -> T.StructType:
    """`name:type|name:type`; all columns are nullable."""
    fields, seen = [], set()
    for part in (text or "").split("|"):
        if not part.strip():
            continue
        name, colon, kind = part.partition(":")
        name = name.strip()
        if not colon or not NAME.fullmatch(name):
            raise RecipeError(f"Columna inválida en el esquema: {part!r}", "SCHEMA_INVALID")
        if name.lower() in seen:
            raise RecipeError(f"Columna repetida en el esquema: {name}", "SCHEMA_DUPLICATE")
        seen.add(name.lower())
        fields.append(T.StructField(name, spark_type(kind), True))
    if not fields:
        raise RecipeError("El esquema está vacío", "SCHEMA_EMPTY")
    return T.StructType(fields)


def plain_name(name: str) -> str:
    """A column name without accents, blanks and signs, in lower case."""
    ascii_only = "".join(c for c in unicodedata.normalize("NFKD", name.strip()) if not unicodedata.combining(c))
    out = re.sub(r"[^A-Za-z0-9]+", "_", ascii_only).strip("_").lower()
    if out[:1].isdigit():
        out = f"col_{out}"
    if not NAME.fullmatch(out):
        raise RecipeError(f"El nombre {name!r} no se puede normalizar", "COLUMN_NAME_INVALID")
    return out


def column(name: str):
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, names: list[str], step: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise RecipeError(f"{step}: columnas inexistentes {missing}; disponibles {df.columns}", "COLUMN_MISSING")


def normalise_columns(df: DataFrame, active: bool) -> DataFrame:
    if not active:
        bad = [c for c in df.columns if not NAME.fullmatch(c)]
        if bad:
            raise RecipeError(f"Nombres de columna inválidos: {bad}", "COLUMN_NAME_INVALID")
        return df
    names = [plain_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise RecipeError(f"Nombres repetidos tras normalizar: {names}", "COLUMN_NAME_COLLISION")
    return df.toDF(*names)


def void_to_string(df: DataFrame) -> DataFrame:
    void = {f.name: column(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    return df.withColumns(void) if void else df


def forced_types(df: DataFrame, kinds: dict[str, str], watch: Watch | None = None) -> DataFrame:
    """Cast columns; values that can't be cast in any of them are an error.

    They are found by one job now or, with a watch, by the job that reads the result; watch.verify() raises then.
    """
    if not kinds:
        return df
    require_columns(df, list(kinds), "tipos_forzados")
    cast = {c: column(c).cast("string").try_cast(spark_type(k)) if isinstance(df.schema[c].dataType, T.StringType) else column(c).try_cast(spark_type(k)) for c, k in kinds.items()}
    lost = [F.max(F.when(column(c).isNotNull() & (F.trim(column(c).cast("string")) != "") & cast[c].isNull(), 1).otherwise(0)).alias(f"perdidos{i}") for i, c in enumerate(kinds)]

    def check(row: dict) -> None:
        bad = [c for i, c in enumerate(kinds) if row[f"perdidos{i}"]]
        if bad:
            raise RecipeError(f"Valores que no se pueden convertir en {bad}", "FORCED_TYPE_INVALID")

    if watch is not None:
        return watch.over(df, lost, check).withColumns(cast)
    check(df.select(*lost).first().asDict())
    return df.withColumns(cast)


def as_bool(value) -> bool:
    if isinstance(value, bool):
        return value
    word = str(value).strip().lower()
    if word in TRUE_WORDS | FALSE_WORDS:
        return word in TRUE_WORDS
    raise RecipeError(f"Valor booleano inválido: {value!r}", "BOOLEAN_INVALID")


def check_evolution(old: T.StructType, new: T.StructType) -> list[str]:
    """The columns that new adds at the end; anything but added trailing columns is an error."""
    before, after = old.fields, new.fields
    if len(after) < len(before):
        gone = [f.name for f in before if f.name not in new.names]
        raise RecipeError(f"ELIMINACION_COLUMNAS: {gone}", "ELIMINACION_COLUMNAS")
    for a, b in zip(before, after, strict=False):
        if a.name != b.name:
            code = "ELIMINACION_COLUMNAS" if a.name not in new.names else "REORDENAMIENTO_COLUMNAS"
            raise RecipeError(f"{code}: se esperaba {a.name}, llegó {b.name}", code)
        if a.dataType != b.dataType:
            raise RecipeError(f"CAMBIO_TIPO: {a.name} de {a.dataType.simpleString()} a {b.dataType.simpleString()}", "CAMBIO_TIPO")
    return [f.name for f in after[len(before) :]]
