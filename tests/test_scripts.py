import collections
import random
import re

import pytest

from flowspark.errors import FlowError, ScriptError
from flowspark.functions.exprs import Node, lower
from flowspark.plans.compiler import compile_script
from flowspark.plans.executor import Executor, reused
from flowspark.plans.lexer import normalise, tokenize
from flowspark.plans.ops import Filter, Plan, Project, Publish
from flowspark.plans.parser import Parser
from flowspark.queries import WAREHOUSE


def node(text: str) -> Node:
    return Parser(tokenize(text)).expression()


def values(spark, text: str, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(lower(node(text))).collect()]


@pytest.mark.parametrize(
    ("text", "rows", "schema", "expected"),
    [
        ("Match(v, 'rojo', 'azul', 'rojo', 'gris')", [("azul",), ("rojo",), ("gris",), ("Rojo",), (None,)], "v string", [2, 1, 4, 0, 0]),
        (r"IndexRegEx(v, '[xyz]{2}')", [("paxyz",), ("xay",), ("",), (None,)], "v string", [3, 0, 0, None]),
        (r"IndexRegEx(v, 'o\\w', 2)", [("roto ojo",), ("oso",), (None,)], "v string", [6, 0, None]),
        ("If(Match(v, 2), 'par', 'impar')", [(2,), (3,), (None,)], "v int", ["par", "impar", "impar"]),
        ("IsNull(v)", [(None,), ("x",)], "v string", [-1, 0]),
        ("Num(v)", [("123.45",), ("$ -7",), ("abc",), (None,)], "v string", [123.45, -7.0, 0.0, 0.0]),
        ("Month(v)", [("2024-07-15",)], "v string", [7]),
        ("Year(v)", [("2024-07-15",)], "v string", [2024]),
        ("v = 1", [(1,), (None,)], "v int", [True, False]),
        ("v <> 1", [(1,), (2,), (None,)], "v int", [False, True, True]),
        ("NOT (v > 1 AND False())", [(2,), (None,)], "v int", [True, True]),
        ("v + 2 * 3 - -1", [(1,)], "v int", [8.0]),
        ("Concat(v, 'x')", [("a",), (None,)], "v string", ["ax", None]),
        ("Concat()", [("a",)], "v string", [""]),
        ("[a.b]", [(3,)], "`a.b` int", [3]),
    ],
)
def test_expressions(spark, text, rows, schema, expected):
    assert values(spark, text, rows, schema) == expected


@pytest.mark.parametrize("seed", range(6))
def test_operators_bind_as_in_python(spark, seed):
    """Random expressions against Python's own reading of them (whose `not`, `and` and `or` bind alike)."""
    rnd = random.Random(seed)

    def number(depth):
        if depth == 0 or rnd.random() < 0.2:
            return str(rnd.randint(1, 9))
        return rnd.choice(["{} + {}", "{} - {}", "{} * {}", "{} / 4", "({})", "-{}"]).format(number(depth - 1), number(depth - 1))

    def truth(depth):
        if depth == 0:
            return f"{number(2)} {rnd.choice(['=', '<>', '<', '>', '<=', '>='])} {number(2)}"
        return rnd.choice(["{} AND {}", "{} OR {}", "NOT {}", "({})", "{} OR {} AND {}"]).format(*[truth(depth - 1) for _ in range(3)])

    for _ in range(20):
        text = truth(3)
        python = re.sub(r"(?<![<>!])=", "==", text.replace("<>", "!=")).replace("AND", "and").replace("OR", "or").replace("NOT", "not")
        assert values(spark, text, [(1,)], "x int") == [eval(python)], text  # noqa: S307


def test_not_within_comparisons():
    assert str(node("a = NOT b = c")) == str(node("(a = (NOT b)) = c"))
    assert str(node("NOT a = b AND c")) == str(node("(NOT (a = b)) AND c"))
    assert str(node("- a * b - c")) == str(node("((-a) * b) - c"))


def test_limits():
    Parser(tokenize("LOAD a FROM t WHERE " + " AND ".join(["a = 1"] * 200))).load()
    too_much = {
        "DFS_SYNTAX_TOO_MANY_CONDITIONS": "a: LOAD x RESIDENT t WHERE " + " OR ".join(["NOT x = 1"] * 201) + ";",
        "DFS_SYNTAX_LINE_TOO_LONG": "a: LOAD x RESIDENT t;\n" + " " * 10_001,
        "DFS_SYNTAX_TOO_DEEP": "a: LOAD " + "(" * 51 + "x" + ")" * 51 + " RESIDENT t;",
        "DFS_SYNTAX_IDENTIFIER_TOO_LONG": "a: LOAD " + "x" * 257 + " RESIDENT t;",
    }
    for code, text in too_much.items():
        with pytest.raises(ScriptError) as e:
            compile_script(text, ("t",))
        assert e.value.errors[0].code == code
    with pytest.raises(ScriptError):
        compile_script("a: LOAD " + "NOT " * 60 + "x RESIDENT t;", ("t",))


def test_rank(spark):
    rows = [("u", 7, 1), ("u", 9, 2), ("u", 9, 3), ("u", 7, 4), ("v", 1, 5), (None, 2, 6)]
    df = spark.createDataFrame(rows, "g string, puntos int, fila int").select("fila", lower(node("Window(WRank(1,1), g, 'DESC', puntos)")).alias("k"))
    assert {r["fila"]: r["k"] for r in df.collect()} == {1: 3, 2: 1, 3: 1, 4: 3, 5: 1, 6: 1}
    for bad in ("Window(WRank(), a, 'ASC', b)", "Window(WRank(1,2), a, 'ASC', b)", "Window(WRank(1,1), a, b)", "WRank(1,1)", "Window(Sum(a), 'ASC', b)"):
        with pytest.raises(FlowError):
            lower(node(bad))


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    executor = Executor(spark, tables={"t": spark.read.parquet(str(tmp_path / "t"))})
    df = executor.run(compile_script("r: LOAD id RESIDENT t WHERE id > 5;", ("t",)))["r"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and df.count() == 4


def test_comments_and_places():
    text = normalise("﻿a: LOAD b // x\r\n/* y\n */ RESIDENT c; -- z")
    assert "x" not in text and text.count("\n") == 2
    assert normalise("LOAD 'a//b' FROM [lib://c/d.csv];") == "LOAD 'a//b' FROM [lib://c/d.csv];"


@pytest.mark.parametrize(
    ("text", "code"),
    [
        ("a: LOAD x RESIDENT nada;", "DFS_SEMANTIC_RESIDENT_FUTURE"),
        ("a: LOAD x FROM [lib://c/f.csv]; DROP TABLE a; b: LOAD x RESIDENT a;", "DFS_SEMANTIC_TABLE_DROPPED"),
        ("DROP TABLE a;", "DFS_SEMANTIC_DROP_NONEXISTENT"),
        ("a: LOAD x, y AS x FROM [lib://c/f.csv];", "DFS_SEMANTIC_DUPLICATE_ALIAS"),
        ("a: LOAD x + 1 FROM [lib://c/f.csv];", "DFS_ALIAS_REQUIRED"),
        ("a: LOAD Dual(x, 1) AS d FROM [lib://c/f.csv];", "EXPR_UNKNOWN_FUNCTION"),
        ("a: SELECT x FROM t;", "DFS_SEMANTIC_SELECT_NO_CONNECTION"),
        ("a: LOAD x;", "DFS_SEMANTIC_LOAD_NO_SOURCE"),
        ("a: LOAD x, Sum(y) AS s FROM [lib://c/f.csv] GROUP BY z;", "DFS_SEMANTIC_GROUP_COLUMN"),
        ("a: LOAD x FROM [lib://c/f.csv] ORDER BY x;", "DFS_UNSUPPORTED_CONSTRUCT"),
        ("a: LOAD x % 2 AS y FROM [lib://c/f.csv];", "DFS_SYNTAX_UNKNOWN_CHAR"),
        ("a: LOAD Sum(x AS s FROM [lib://c/f.csv];", "DFS_SYNTAX_UNEXPECTED_TOKEN"),
        ("   ", "DFS_SCRIPT_EMPTY"),
        ("SET a = 1;", "DFS_EMPTY_PLAN"),
        ("STORE x INTO [lib://c/f.csv];", "DFS_SEMANTIC_TABLE_NOT_FOUND"),
    ],
)
def test_errors(text, code):
    with pytest.raises(ScriptError) as e:
        compile_script(text)
    assert code in [x.code for x in e.value.errors]


def test_plan_round_trip():
    plan = compile_script("SET v = 'x'; a: LOAD DISTINCT x, If(y > 1, 'a', 'b') AS z FROM [lib://c/f.csv] WHERE NOT IsNull(x); STORE a INTO [lib://c/o.csv] (csv);")
    assert Plan.from_json(plan.to_json(), plan.hash) == plan and len(set(plan.ids)) == len(plan.ids)
    assert "publicar" in plan.explain() and plan.metadata["variables"] == {"v": "x"}
    with pytest.raises(FlowError):
        Plan.from_json(plan.to_json(), "0" * 64)
    with pytest.raises(FlowError):
        Plan.of({"operaciones": [{"tipo": "volar"}]})


def test_shared_tables_are_kept():
    plan = Plan((Project("t", ("*",), "a"), Filter("a", "x > 1"), Publish("a", "lib://c/1.csv"), Project("a", ("*",), "b"), Publish("b", "lib://c/2.csv")))
    assert reused(plan) == {1}


def test_text_conditions(spark):
    executor = Executor(spark, tables={"t": spark.range(3)})
    assert executor.run(Plan((Filter("t", "id > 1"),)))["t"].count() == 1
    with pytest.raises(FlowError):
        executor.run(Plan((Filter("t", "id > 1; drop"),)))


def test_joins_and_concat(spark):
    left = spark.createDataFrame([(1, "N", "v1"), (2, "S", "v2")], "id long, region string, venta string")
    right = spark.createDataFrame([(1, "N", "c1")], "id long, region string, cliente string")
    tables = {"l": left, "r": right}
    out = Executor(spark, tables=dict(tables)).run(compile_script("LEFT JOIN (l) LOAD id, region, cliente RESIDENT r;", ("l", "r")))["l"]
    assert out.columns == ["id", "region", "venta", "cliente"] and sorted(map(tuple, out.collect())) == [(1, "N", "v1", "c1"), (2, "S", "v2", None)]
    with pytest.raises(FlowError):
        Executor(spark, tables=dict(tables)).run(compile_script("LEFT JOIN (l) LOAD cliente AS otra RESIDENT r;", ("l", "r")))
    out = Executor(spark, tables=dict(tables)).run(compile_script("CONCATENATE (l) LOAD id, cliente RESIDENT r;", ("l", "r")))["l"]
    assert out.columns == ["id", "region", "venta", "cliente"] and out.count() == 3


def test_shape_of_the_nightly_load():
    """Relational sources, joins, ranks and publications come out of the script as they were written; the plan is the same each time."""
    plan = compile_script(WAREHOUSE, ("lineitem",))
    kinds = collections.Counter(op.tipo for op in plan.operaciones)
    assert (kinds["leer_jdbc"], kinds["unir"], kinds["publicar"], kinds["concatenar"], kinds["filtrar"], kinds["agregar"]) == (7, 7, 4, 1, 2, 2)
    assert plan.hash == compile_script(WAREHOUSE, ("lineitem",)).hash and Plan.from_json(plan.to_json()).hash == plan.hash
    assert reused(plan)
