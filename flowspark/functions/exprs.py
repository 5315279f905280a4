"""Script expressions: typed nodes, and their lowering to Spark columns.

Truth is numeric (zero is false); `=` and `<>` are null-safe; AND, OR and NOT have three values.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import FlowError
from ..operators.ranking import plain_rank
from ..types import column

#: Kinds of nodes.
COLUMN, NUMBER, STRING, STAR, CALL, UNARY, BINARY, DISTINCT, WINDOW = "columna", "numero", "cadena", "todo", "funcion", "unario", "binario", "distinto", "ventana"
COMPARISONS = ("=", "<>", "<", ">", "<=", ">=")
AGGREGATES = {"SUM", "AVG", "COUNT", "MIN", "MAX"}


@dataclass(frozen=True)
class Node:
    kind: str
    value: str = ""
    children: tuple[Node, ...] = field(default_factory=tuple)

    def as_dict(self) -> dict:
        return {"tipo": self.kind, "valor": self.value, "hijos": [c.as_dict() for c in self.children]}

    @classmethod
    def of(cls, doc: dict) -> Node:
        return cls(doc["tipo"], doc.get("valor", ""), tuple(cls.of(c) for c in doc.get("hijos", [])))

    def columns(self) -> list[str]:
        own = [self.value] if self.kind == COLUMN else []
        return list(dict.fromkeys(own + [x for c in self.children for x in c.columns()]))

    def has_aggregate(self) -> bool:
        return self.kind == CALL and self.value in AGGREGATES or any(c.has_aggregate() for c in self.children)


def problem(code: str, message: str) -> FlowError:
    return FlowError(message, code)


def literal_string(node: Node, what: str) -> str:
    if node.kind != STRING:
        raise problem("EXPR_LITERAL_REQUIRED", f"{what} debe ser un literal")
    return node.value


def literal_int(node: Node, what: str) -> int:
    if node.kind != NUMBER or not float(node.value).is_integer():
        raise problem("EXPR_LITERAL_REQUIRED", f"{what} debe ser un entero literal")
    return int(float(node.value))


def predicate(node: Node) -> Column:
    """The node as a condition; other types are cast, so that numbers are true unless zero."""
    out = lower(node)
    return out if is_boolean(node) else out.cast("boolean")


def is_boolean(node: Node) -> bool:
    return node.kind == BINARY and node.value in (*COMPARISONS, "AND", "OR") or node.kind == UNARY and node.value == "NOT" or node.kind == CALL and node.value == "FALSE"


def index_regex(args: tuple[Node, ...]) -> Column:
    """1-based start of the n-th match; 0 if there is none; null for null."""
    text, pattern = lower(args[0]), literal_string(args[1], "El patrón")
    n = literal_int(args[2], "La ocurrencia") if len(args) > 2 else 1
    if n < 1:
        raise problem("EXPR_REGEX_OCCURRENCE", "La ocurrencia debe ser 1 o más")
    if n == 1:
        return F.regexp_instr(text, F.lit(pattern))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The text before the n-th match: what lies between matches, and the matches before it.
    before = F.aggregate(F.slice(F.split(text, pattern, -1), 1, n), F.lit(0), lambda a, x: a + F.length(x))
    within = F.aggregate(F.slice(found, 1, n - 1), F.lit(0), lambda a, x: a + F.length(x))
    return F.when(text.isNull(), F.lit(None).cast("int")).when(F.size(found) >= n, before + within + 1).otherwise(F.lit(0))


def match(args: tuple[Node, ...]) -> Column:
    value, out = lower(args[0]), F.lit(0)
    for i in range(len(args) - 1, 0, -1):
        out = F.when(value.eqNullSafe(lower(args[i])), F.lit(i)).otherwise(out)
    return out


def number(args: tuple[Node, ...]) -> Column:
    """Digits, points, commas and signs as a number; what is none is 0."""
    if not args:
        return F.lit(0.0)
    kept = F.regexp_replace(lower(args[0]).cast("string"), r"[^\d.,-]", "")
    return F.coalesce(kept.try_cast("double"), F.lit(0.0))


def count(args: tuple[Node, ...]) -> Column:
    if len(args) != 1:
        raise problem("EXPR_ARITY", "Count necesita un argumento")
    if args[0].kind == STAR:
        return F.count(F.lit(1))
    if args[0].kind == DISTINCT:
        return F.countDistinct(lower(args[0].children[0]))
    return F.count(lower(args[0]))


def each(f: Callable[..., Column]) -> Callable[[tuple[Node, ...]], Column]:
    return lambda args: f(*map(lower, args))


#: name: (fewest arguments, most, builder)
FUNCTIONS: dict[str, tuple[int, float, Callable[[tuple[Node, ...]], Column]]] = {
    "TRIM": (1, 1, each(F.trim)),
    "IF": (3, 3, lambda a: F.when(F.coalesce(predicate(a[0]), F.lit(False)), lower(a[1])).otherwise(lower(a[2]))),
    "MATCH": (2, math.inf, match),
    "COALESCE": (1, math.inf, each(F.coalesce)),
    "IFNULL": (2, 2, each(F.coalesce)),
    "ISNULL": (1, 1, lambda a: F.when(lower(a[0]).isNull(), F.lit(-1)).otherwise(F.lit(0))),
    "INDEXREGEX": (2, 3, index_regex),
    "NUM": (0, 1, number),
    "MONTH": (1, 1, each(F.month)),
    "YEAR": (1, 1, each(F.year)),
    "DAY": (1, 1, each(F.dayofmonth)),
    "DATE": (1, 2, lambda a: F.to_date(lower(a[0]), literal_string(a[1], "El formato")) if len(a) > 1 else F.to_date(lower(a[0]))),
    "CONCAT": (0, math.inf, lambda a: F.concat(*[lower(x).cast("string") for x in a]) if a else F.lit("")),
    "FALSE": (0, 0, lambda a: F.lit(False)),
    "UPPER": (1, 1, each(F.upper)),
    "LOWER": (1, 1, each(F.lower)),
    "LEN": (1, 1, each(F.length)),
    "LENGTH": (1, 1, each(F.length)),
    "LEFT": (2, 2, lambda a: F.left(lower(a[0]), lower(a[1]).cast("int"))),
    "SUBSTRING": (2, 3, lambda a: F.substr(lower(a[0]), *[lower(x).cast("int") for x in a[1:]])),
    "MID": (2, 3, lambda a: F.substr(lower(a[0]), *[lower(x).cast("int") for x in a[1:]])),
    "TEXT": (1, 1, lambda a: lower(a[0]).cast("string")),
    "SUM": (1, 1, each(F.sum)),
    "AVG": (1, 1, each(F.avg)),
    "MIN": (1, 1, each(F.min)),
    "MAX": (1, 1, each(F.max)),
    "COUNT": (1, 1, count),
}
#: Words that the grammar knows as functions but that have no meaning here.
REJECTED = {"DUAL", "RIGHT"}


@dataclass(frozen=True)
class Ranking:
    """A parsed window: mode 1 (competition rank) or 4 (row number), what it is partitioned and ordered by, and whether downwards."""

    mode: int
    partition: tuple[Node, ...]
    order: tuple[Node, ...]
    down: bool


def ranking(node: Node) -> Ranking:
    """Window(WRank(mode, format), partition..., 'ASC'|'DESC', order...)."""
    rank, *rest = node.children or (Node(CALL),)
    if rank.kind != CALL or rank.value != "WRANK":
        raise problem("EXPR_WINDOW_FUNCTION", "Window admite solo WRank")
    mode, form = ([literal_int(a, "WRank") for a in rank.children] + [0, 0][len(rank.children) :])[:2]
    if mode not in (1, 4):
        raise problem("EXPR_WRANK_MODE_UNSUPPORTED", f"WRank: modo {mode} no soportado")
    if form != 1:
        raise problem("EXPR_WRANK_FMT_UNSUPPORTED", f"WRank: formato {form} no soportado")
    cuts = [i for i, n in enumerate(rest) if n.kind == STRING and n.value.upper() in ("ASC", "DESC")]
    if len(cuts) != 1 or cuts[0] == len(rest) - 1:
        raise problem("EXPR_WINDOW_ORDER", "Window necesita una dirección y columnas de orden")
    return Ranking(mode, tuple(rest[: cuts[0]]), tuple(rest[cuts[0] + 1 :]), rest[cuts[0]].value.upper() == "DESC")


def window(node: Node) -> Column:
    r = ranking(node)
    return plain_rank([lower(n) for n in r.partition], [lower(n) for n in r.order], r.down, r.mode)


def whole_number(node: Node) -> int | None:
    """An integral literal that a double holds exactly; comparing with it as a long lets integer columns push the filter down."""
    if node.kind == UNARY and node.value == "-" and (n := whole_number(node.children[0])) is not None:
        return -n
    if node.kind == NUMBER and float(node.value).is_integer() and abs(float(node.value)) < 2**53:
        return int(float(node.value))
    return None


def compare(op: str, left: Node, right: Node) -> Column:
    a, b = (F.lit(n).cast("bigint") if (n := whole_number(x)) is not None else lower(x) for x in (left, right))
    table = {"=": a.eqNullSafe, "<>": lambda y: ~a.eqNullSafe(y), "<": a.__lt__, ">": a.__gt__, "<=": a.__le__, ">=": a.__ge__}
    return table[op](b)


def lower(node: Node) -> Column:
    """The Spark column of a node."""
    if node.kind == COLUMN:
        return column(node.value)
    if node.kind == NUMBER:
        return F.lit(float(node.value))
    if node.kind == STRING:
        return F.lit(node.value)
    if node.kind == WINDOW:
        return window(node)
    if node.kind == UNARY:
        return ~predicate(node.children[0]) if node.value == "NOT" else -lower(node.children[0])
    if node.kind == BINARY:
        left, right = node.children
        if node.value == "AND":
            return predicate(left) & predicate(right)
        if node.value == "OR":
            return predicate(left) | predicate(right)
        if node.value in COMPARISONS:
            return compare(node.value, left, right)
        a, b = lower(left), lower(right)
        return {"+": a + b, "-": a - b, "*": a * b, "/": a / b}[node.value]
    if node.kind == CALL:
        check_call(node)
        return FUNCTIONS[node.value][2](node.children)
    raise problem("EXPR_UNKNOWN_NODE", f"Nodo fuera de lugar: {node.kind} {node.value}")


def check_call(node: Node) -> None:
    """A call's name and number of arguments."""
    if node.value == "WRANK":
        raise problem("EXPR_WRANK_OUTSIDE_WINDOW", "WRank solo vale dentro de Window")
    if node.value not in FUNCTIONS:
        raise problem("EXPR_UNKNOWN_FUNCTION", f"Función no soportada: {node.value}")
    fewest, most, _ = FUNCTIONS[node.value]
    if not fewest <= len(node.children) <= most:
        raise problem("EXPR_ARITY", f"{node.value}: {len(node.children)} argumentos")


def check(node: Node) -> None:
    """Everything that lowering would reject, without Spark."""
    if node.kind == CALL:
        check_call(node)
        if node.value == "INDEXREGEX":
            literal_string(node.children[1], "El patrón")
            if len(node.children) > 2 and literal_int(node.children[2], "La ocurrencia") < 1:
                raise problem("EXPR_REGEX_OCCURRENCE", "La ocurrencia debe ser 1 o más")
        if any(c.kind in (STAR, DISTINCT) for c in node.children) and node.value != "COUNT":
            raise problem("DFS_UNSUPPORTED_DISTINCT", f"* y DISTINCT solo valen en Count, no en {node.value}")
    if node.kind == WINDOW:
        rank, *rest = node.children or (Node(CALL),)
        if rank.kind != CALL or rank.value != "WRANK":
            raise problem("EXPR_WINDOW_FUNCTION", "Window admite solo WRank")
        mode, form = ([literal_int(a, "WRank") for a in rank.children] + [0, 0][len(rank.children) :])[:2]
        if mode not in (1, 4):
            raise problem("EXPR_WRANK_MODE_UNSUPPORTED", f"WRank: modo {mode} no soportado")
        if form != 1:
            raise problem("EXPR_WRANK_FMT_UNSUPPORTED", f"WRank: formato {form} no soportado")
        cuts = [i for i, n in enumerate(rest) if n.kind == STRING and n.value.upper() in ("ASC", "DESC")]
        if len(cuts) != 1 or cuts[0] == len(rest) - 1:
            raise problem("EXPR_WINDOW_ORDER", "Window necesita una dirección y columnas de orden")
        for child in rest:
            check(child)
        return
    for child in node.children:
        check(child)


def show(node: Node) -> str:
    """Readable text of a node."""
    if node.kind == STRING:
        return "'" + node.value.replace("'", "''") + "'"
    if node.kind == BINARY:
        return f"({show(node.children[0])} {node.value} {show(node.children[1])})"
    if node.kind == UNARY:
        return f"{node.value} {show(node.children[0])}"
    if node.kind == STAR:
        return "*"
    if node.kind == DISTINCT:
        return f"DISTINCT {show(node.children[0])}"
    if node.kind in (CALL, WINDOW):
        return f"{node.value or 'WINDOW'}({', '.join(map(show, node.children))})"
    return node.value
