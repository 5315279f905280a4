"""Joins, by-name concatenation and aggregation of whole tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import FlowError
from ..types import column
from .skew import dealt, heavy_keys, parts_of

JOIN_KINDS = {"LEFT": "left", "INNER": "inner"}
EQUAL = re.compile(r"\s*(?:(\w+)\.)?(\w+)\s*=\s*(?:(\w+)\.)?(\w+)\s*")
METRIC = re.compile(r"\s*(COUNT|SUM|AVG|MIN|MAX)\s*\(\s*(DISTINCT\s+)?([^()]+?)\s*\)\s+AS\s+(\S+)\s*", re.IGNORECASE)


def join_kind(word: str) -> str:
    if word.upper() not in JOIN_KINDS:
        raise FlowError(f"Tipo de join no soportado: {word}", "JOIN_UNSUPPORTED")
    return JOIN_KINDS[word.upper()]


SALT = "_flow_parte"


def joined(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], kind: str, keep: list, share: float | None) -> DataFrame:
    """Left and right by equality of the pairs of columns. share: keys with so much of left's rows are split (see skew), which one job looks for first."""
    salted = False
    if share is not None:
        own, other = [column(a) for a, _ in pairs], [column(b) for _, b in pairs]
        # Equal keys have equal hashes only if they have one type.
        if all(left.schema[a].dataType == right.schema[b].dataType for a, b in pairs):
            heavy, total = heavy_keys(left, own, share)
            if heavy:
                partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                left, right = dealt(left, right, own, other, parts_of(heavy, total, partitions), SALT)
                salted = True
    l, r = left.alias("l"), right.alias("r")  # noqa: E741
    on = F.lit(True)
    for a, b in [*pairs, (SALT, SALT)] if salted else pairs:
        on = on & (F.col(f"l.`{a}`") == F.col(f"r.`{b}`"))
    return l.join(r, on, kind).select(*keep)


def natural_join(left: DataFrame, right: DataFrame, kind: str = "LEFT", share: float | None = None) -> DataFrame:
    """Equality on all common columns (null matches nothing): keys, left's rest, right's rest."""
    common = [c for c in left.columns if c in set(right.columns)]
    if not common:
        raise FlowError("Las tablas no tienen columnas comunes (producto cartesiano)", "JOIN_CARTESIAN")
    keep = [F.col(f"l.`{c}`") for c in common] + [F.col(f"l.`{c}`") for c in left.columns if c not in common] + [F.col(f"r.`{c}`") for c in right.columns if c not in common]
    return joined(left, right, [(c, c) for c in common], join_kind(kind), keep, share)


def equi_join(left: DataFrame, right: DataFrame, condition: str, kind: str = "LEFT", share: float | None = None) -> DataFrame:
    """One equality `a = b`, qualifiers ignored; of columns in both tables the left one stays."""
    m = EQUAL.fullmatch(condition)
    if not m:
        raise FlowError(f"Condición de join no soportada: {condition}", "JOIN_CONDITION")
    a, b = m[2], m[4]
    if a not in left.columns and a in right.columns and b in left.columns:
        a, b = b, a
    for name, df in ((a, left), (b, right)):
        if name not in df.columns:
            raise FlowError(f"Columna de join inexistente: {name}", "COLUMN_MISSING")
    keep = [F.col(f"l.`{c}`") for c in left.columns] + [F.col(f"r.`{c}`") for c in right.columns if c not in left.columns]
    return joined(left, right, [(a, b)], join_kind(kind), keep, share)


def join_keys(left: DataFrame, right: DataFrame, condition: str) -> tuple[str, ...]:
    """The left side's columns in a join's condition."""
    if condition.upper() == "NATURAL":
        return tuple(c for c in left.columns if c in set(right.columns))
    m = EQUAL.fullmatch(condition)
    return tuple(c for c in (m[2], m[4]) if c in left.columns)[:1] if m else ()


def concatenate(target: DataFrame, source: DataFrame) -> DataFrame:
    """UNION ALL by name; missing columns are null; target's columns first."""
    kinds = {f.name: f.dataType for f in target.schema.fields}
    text = {f.name for f in source.schema.fields if f.name in kinds and (f.dataType.typeName() == "string") != (kinds[f.name].typeName() == "string")}
    if text:
        raise FlowError(f"CONCATENATE: tipos incompatibles en {sorted(text)}", "CONCAT_TYPES")
    return target.unionByName(source, allowMissingColumns=True)


def metric_text(text: str) -> Column:
    """`FN([DISTINCT] column|*) AS alias`."""
    m = METRIC.fullmatch(text)
    if not m:
        raise FlowError(f"Métrica no soportada: {text}", "METRIC_INVALID")
    fn, distinct, arg, alias = m[1].upper(), bool(m[2]), m[3], m[4].strip('[]"')
    if distinct and fn != "COUNT" or arg == "*" and (fn != "COUNT" or distinct):
        raise FlowError(f"Métrica no soportada: {text}", "METRIC_INVALID")
    if arg == "*":
        return F.count(F.lit(1)).alias(alias)
    source = column(arg.strip('[]"'))
    return (F.countDistinct(source) if distinct else {"COUNT": F.count, "SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max}[fn](source)).alias(alias)


def new_rows(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of batch whose keys are not in existing (left anti join)."""
    return batch.join(existing.select(*map(column, keys)), keys, "left_anti")
