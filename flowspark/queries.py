"""A query for each operator on the test tables, with the same in SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.incremental import IncrementalConfig, run_incremental
from .operators.keyfilter import pruned
from .operators.relational import concatenate, equi_join, natural_join, new_rows
from .operators.steps import apply_steps
from .plans.compiler import compile_script
from .plans.executor import Executor
from .plans.ops import Aggregate, Filter, Plan, Project
from .recipe import load_recipe, run_recipe
from .shared import shared_folder
from .sinks.parquet import OutputConfig, write
from .sinks.publish import publish_store
from .sources import embedded
from .sources.catalog import Secrets, load_catalog
from .sources.jdbc import TargetDatabase
from .sources.reader import InputConfig, read, resolve_schema
from .streaming.csv_sink import stream_to_csv
from .streaming.incremental import stream_incremental
from .types import void_to_string

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recipe(name: str, source: str, steps: list[dict], sql: str) -> None:
    """A query that applies recipe steps to a table."""
    QUERIES[name] = lambda spark, sf_dir: apply_steps(table(spark, sf_dir, source), steps)
    ORACLES[name] = sql


def script(name: str, text: str, result: str, sql: str) -> None:
    """A query that runs a dataflow script over the tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        executor = Executor(spark)
        for t in TABLES:
            if t in text:
                executor.register(t, table(spark, sf_dir, t))
        return executor.run(compile_script(text, TABLES))[result]

    QUERIES[name] = run
    ORACLES[name] = sql


def direct(name: str, sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return add


# --- recipe steps

recipe("step_select", "customer", [{"tipo": "seleccionar_columnas", "columnas": ["c_custkey", "c_mktsegment"]}], "SELECT c_custkey, c_mktsegment FROM customer")
recipe("step_drop", "customer", [{"tipo": "eliminar_columnas", "columnas": ["c_acctbal", "c_name"]}], "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
recipe("step_rename", "nation", [{"tipo": "renombrar_columna", "origen": "n_name", "destino": "pais"}], "SELECT n_nationkey, n_name AS pais, n_regionkey FROM nation")
recipe(
    "step_create", "lineitem",
    [{"tipo": "crear_columna", "nombre": "neto", "expresion": "round(l_extendedprice * (1 - l_discount), 4)"}, {"tipo": "seleccionar_columnas", "columnas": ["l_orderkey", "l_linenumber", "neto"]}],
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS neto FROM lineitem",
)
recipe(
    "step_window_expression", "customer",
    [{"tipo": "crear_columna", "nombre": "puesto", "expresion": "cast(rank() over (partition by c_nationkey order by c_acctbal desc) as bigint)"}, {"tipo": "seleccionar_columnas", "columnas": ["c_custkey", "puesto"]}],
    "SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS puesto FROM customer",
)
recipe(
    "step_convert", "orders",
    [{"tipo": "convertir_tipo", "columna": "o_orderdate", "destino": "fecha"}, {"tipo": "convertir_tipo", "columna": "o_totalprice", "destino": "decimal(14,2)"}, {"tipo": "convertir_tipo", "columna": "o_custkey", "destino": "texto"}, {"tipo": "seleccionar_columnas", "columnas": ["o_orderkey", "o_orderdate", "o_totalprice", "o_custkey"]}],
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders",
)
recipe(
    "step_fill_nulls", "events",
    [{"tipo": "crear_columna", "nombre": "v", "expresion": "case when event_type = 'click' then null else value end"}, {"tipo": "crear_columna", "nombre": "t", "expresion": "nullif(event_type, 'click')"}, {"tipo": "rellenar_nulos", "valores": {"v": -1.0, "t": "none"}}, {"tipo": "seleccionar_columnas", "columnas": ["event_id", "v", "t"]}],
    "SELECT event_id, CASE WHEN event_type = 'click' THEN -1.0::DOUBLE ELSE coalesce(value, -1.0) END AS v, coalesce(nullif(event_type, 'click'), 'none') AS t FROM events",
)
recipe(
    "step_normalise_text", "part",
    [{"tipo": "crear_columna", "nombre": "p_name", "expresion": "concat('  ', p_name, ' ')"}, {"tipo": "normalizar_texto", "columnas": ["p_name"], "operaciones": ["trim", "upper"]}, {"tipo": "normalizar_texto", "columnas": ["p_brand"], "operaciones": ["lower"]}, {"tipo": "seleccionar_columnas", "columnas": ["p_partkey", "p_name", "p_brand"]}],
    "SELECT p_partkey, upper(trim(p_name)) AS p_name, lower(p_brand) AS p_brand FROM part",
)
recipe("step_filter", "orders", [{"tipo": "filtrar", "expresion": "o_orderstatus = 'F' AND o_totalprice > 1000"}], "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
recipe("step_repartition", "supplier", [{"tipo": "reparticionar", "cantidad": 3, "columnas": ["s_nationkey"]}], "SELECT * FROM supplier")
recipe(
    "step_group", "lineitem",
    [{"tipo": "agrupar", "columnas": ["l_returnflag", "l_linestatus"], "metricas": [
        {"operacion": "sum", "columna": "l_quantity", "alias": "suma"}, {"operacion": "avg", "columna": "l_quantity", "alias": "media"}, {"operacion": "min", "columna": "l_shipdate", "alias": "minimo"},
        {"operacion": "max", "columna": "l_shipdate", "alias": "maximo"}, {"operacion": "count", "alias": "n"}, {"operacion": "count", "columna": "l_tax", "alias": "con_tax"}, {"operacion": "count_distinct", "columna": "l_suppkey", "alias": "proveedores"}]},
     {"tipo": "crear_columna", "nombre": "suma", "expresion": "round(suma, 2)"}, {"tipo": "crear_columna", "nombre": "media", "expresion": "round(media, 4)"}],
    "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS suma, round(avg(l_quantity), 4) AS media, min(l_shipdate) AS minimo, max(l_shipdate) AS maximo, count(*) AS n, count(l_tax) AS con_tax, count(DISTINCT l_suppkey) AS proveedores FROM lineitem GROUP BY ALL",
)
recipe(
    "step_group_global", "orders",
    [{"tipo": "agrupar", "columnas": [], "metricas": [{"operacion": "count", "alias": "n"}, {"operacion": "max", "columna": "o_orderkey", "alias": "mayor"}]}],
    "SELECT count(*) AS n, max(o_orderkey) AS mayor FROM orders",
)
recipe(
    "step_group_first_last", "nation",
    [{"tipo": "crear_columna", "nombre": "region", "expresion": "case when n_nationkey % 3 = 1 then concat('r', n_regionkey) end"},
     {"tipo": "agrupar", "columnas": ["n_regionkey"], "metricas": [{"operacion": "first", "columna": "region", "alias": "primera"}, {"operacion": "last", "columna": "region", "alias": "ultima"}]}],
    "SELECT n_regionkey, max(CASE WHEN n_nationkey % 3 = 1 THEN 'r' || n_regionkey END) AS primera, max(CASE WHEN n_nationkey % 3 = 1 THEN 'r' || n_regionkey END) AS ultima FROM nation GROUP BY n_regionkey",
)
recipe("step_distinct_keys", "customer", [{"tipo": "seleccionar_columnas", "columnas": ["c_nationkey", "c_mktsegment"]}, {"tipo": "eliminar_duplicados", "columnas": ["c_nationkey", "c_mktsegment"]}], "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
recipe("step_distinct_rows", "events", [{"tipo": "seleccionar_columnas", "columnas": ["event_type"]}, {"tipo": "eliminar_duplicados", "columnas": []}], "SELECT DISTINCT event_type FROM events")

# --- relational operators


@direct("join_natural_left", "SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey")
def join_natural_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return natural_join(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders)


@direct("join_natural_inner", "SELECT n_nationkey, n_name, s_suppkey FROM nation JOIN supplier ON n_nationkey = s_nationkey")
def join_natural_inner(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return natural_join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), suppliers, "INNER")


@direct("join_equality", "SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def join_equality(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return equi_join(orders, table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "o.o_custkey = c.c_custkey")


@direct("incremental_new_rows", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 16 = 1)")
def incremental_new_rows(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").filter("o_orderkey % 16 = 1").select(F.col("o_custkey").alias("c_custkey"))
    return new_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), seen, ["c_custkey"])


@direct("concat_by_name", "SELECT s_name AS name, s_nationkey AS nation, s_suppkey AS suppkey, NULL::BIGINT AS custkey FROM supplier UNION ALL SELECT c_name, c_nationkey, NULL, c_custkey FROM customer")
def concat_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").selectExpr("s_name AS name", "s_nationkey AS nation", "s_suppkey AS suppkey")
    b = table(spark, sf_dir, "customer").selectExpr("c_custkey AS custkey", "c_name AS name", "c_nationkey AS nation")
    return concatenate(a, b)


@direct("plan_text_metrics", "SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS proveedores, min(l_quantity) AS menor FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_returnflag")
def plan_text_metrics(spark, sf_dir):
    executor = Executor(spark)
    executor.register("lineitem", table(spark, sf_dir, "lineitem"))
    plan = Plan((
        Project("lineitem", ("l_returnflag", "l_suppkey", "l_quantity", "l_linenumber"), "t", (("l_linenumber", "k"),)),
        Filter("t", "k <= 3"),
        Aggregate("t", ("l_returnflag",), ("COUNT(*) AS n", "COUNT(DISTINCT l_suppkey) AS proveedores", "MIN(l_quantity) AS menor"), (), "r"),
    ))
    return executor.run(plan)["r"]


@direct("plan_text_sums", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS suma, round(avg(l_quantity), 4) AS media, max(l_shipdate) AS ultima, count(l_tax) AS n FROM lineitem GROUP BY ALL")
def plan_text_sums(spark, sf_dir):
    executor = Executor(spark)
    executor.register("lineitem", table(spark, sf_dir, "lineitem"))
    metrics = ("SUM(l_quantity) AS suma", "AVG(l_quantity) AS media", "MAX(l_shipdate) AS ultima", "COUNT(l_tax) AS n")
    found = executor.run(Plan((Aggregate("lineitem", ("l_returnflag", "l_linestatus"), metrics, (), "r"),)))["r"]
    return found.withColumns({"suma": F.round("suma", 2), "media": F.round("media", 4)})


@direct("plan_from_json", "SELECT s_nationkey AS pais, count(*) AS n, max(s_suppkey) AS ultimo FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey")
def plan_from_json(spark, sf_dir):
    """A plan that went through its JSON form, whose hash is checked on the way back."""
    plan = compile_script("r: LOAD s_nationkey AS pais, Count(*) AS n, Max(s_suppkey) AS ultimo RESIDENT supplier WHERE s_acctbal > 0 GROUP BY s_nationkey;", TABLES)
    executor = Executor(spark)
    executor.register("supplier", table(spark, sf_dir, "supplier"))
    return executor.run(Plan.from_json(plan.to_json(), plan.hash))["r"]


# --- sources and sinks: tables go through files in the shared folder and come back


def as_csv(df: DataFrame, name: str, separator: str = ",") -> str:
    path = shared_folder(df.sparkSession, name)
    df.write.options(header="true", sep=separator).csv(path)
    return path


@direct("source_declared_csv", "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def source_declared_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderstatus", "cast(o_totalprice as decimal(14,2)) AS o_totalprice", "cast(o_orderdate as date) AS o_orderdate")
    config = InputConfig.of({"formato": "csv", "opciones": {"header": True, "sep": "|"}})
    schema = resolve_schema(config, "o_orderkey:long|o_orderstatus:texto|o_totalprice:decimal(14,2)|o_orderdate:fecha")
    return read(spark, as_csv(orders, "orders", "|"), schema, config)


@direct("source_inferred_csv", "SELECT c_custkey AS numero_de_cliente, c_name AS nombre, CAST(c_acctbal AS VARCHAR) AS col_2026_saldo, c_nationkey AS pais FROM customer")
def source_inferred_csv(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS `Número de cliente`", "c_name AS ` Nombre`", "c_acctbal AS `2026 saldo`", "c_nationkey AS `PAÍS`")
    config = InputConfig.of({"modo_esquema": "inferir", "tipos_forzados": {"numero_de_cliente": "long", "col_2026_saldo": "string", "pais": "int"}})
    return read(spark, as_csv(customers, "customer"), None, config)


@direct("source_parquet", "SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal FROM supplier")
def source_parquet(spark, sf_dir):
    config = InputConfig.of({"formato": "parquet", "modo_esquema": "inferir", "tipos_forzados": {"s_acctbal": "decimal(12,2)"}})
    return read(spark, f"{sf_dir}/supplier.parquet", None, config)


@direct("source_void_columns", "SELECT n_nationkey, CAST(NULL AS VARCHAR) AS nada FROM nation")
def source_void_columns(spark, sf_dir):
    return void_to_string(table(spark, sf_dir, "nation").select("n_nationkey", F.lit(None).alias("nada")))


@direct("sink_parquet", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem")
def sink_parquet(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    path = shared_folder(spark, "lineitem")
    config = OutputConfig.of({"numero_particiones": 3, "columnas_reparticion": ["l_orderkey"], "particionar_por": ["l_returnflag", "l_linestatus"], "compresion": "zstd"})
    write(spark, lines, path, config)
    return spark.read.parquet(path)


@direct("sink_planned_files", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate, CASE WHEN l_orderkey % 8 = 0 THEN l_returnflag ELSE 'X' END AS g FROM lineitem")
def sink_planned_files(spark, sf_dir):
    """A table of which most rows lie in one folder, in files of a planned size."""
    path = shared_folder(spark, "lineitem")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", F.expr("CASE WHEN l_orderkey % 8 = 0 THEN l_returnflag ELSE 'X' END AS g"))
    write(spark, lines, path, OutputConfig.of({"particionar_por": ["g"], "tamano_archivo_mb": 0.125, "compresion": "zstd"}))
    return spark.read.parquet(path)


@direct("sink_metrics", "SELECT CAST(2 AS BIGINT) AS archivos, TRUE AS success, TRUE AS bytes")
def sink_metrics(spark, sf_dir):
    """What the sink's check of its own output finds."""
    path = shared_folder(spark, "part")
    found = write(spark, table(spark, sf_dir, "part"), path, OutputConfig.of({"numero_particiones": 2}))
    row = (found["cantidad_archivos_parquet"], found["archivo_success"], found["bytes_parquet"] > 0)
    return spark.createDataFrame([row], "archivos long, success boolean, bytes boolean")


@direct("recipe_run", "SELECT c_custkey, upper(trim(c_mktsegment)) AS c_mktsegment, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal FROM customer WHERE c_acctbal > 0")
def recipe_run(spark, sf_dir):
    """A recipe from its document to its verified output, read back."""
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey", "concat(' ', c_mktsegment) AS c_mktsegment", "cast(c_acctbal as decimal(12,2)) AS c_acctbal")
    doc = {
        "entrada": {"opciones": {"header": True}},
        "pasos": [{"tipo": "normalizar_texto", "columnas": ["c_mktsegment"], "operaciones": ["trim", "upper"]}, {"tipo": "filtrar", "expresion": "c_acctbal > 0"}],
        "salida": {"formato": "parquet", "particionar_por": ["c_mktsegment"]},
        "auditoria": {"contar_registros": True},
    }
    target = shared_folder(spark, "recipe")
    run_recipe(spark, load_recipe(json.dumps(doc)), as_csv(customers, "customer"), target, "c_custkey:long|c_mktsegment:string|c_acctbal:decimal(12,2)", "q", lambda _: None)
    return spark.read.parquet(target)


@direct("incremental_write", "SELECT o_custkey, min(o_orderkey) FILTER (o_orderkey % 2 = 0 OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)) AS o_orderkey FROM orders GROUP BY o_custkey")
def incremental_write(spark, sf_dir):
    """Two loads into one target: the second adds the customers that the first lacks, each with its least order."""
    orders, target = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), shared_folder(spark, "orders")
    config, output = IncrementalConfig.of({"activo": True, "claves": ["o_custkey"]}), OutputConfig.of({"modo": "append"})
    for batch in (orders.filter("o_orderkey % 2 = 0"), orders):
        run_incremental(spark, batch, target, config, output)
    return spark.read.parquet(target)


@direct("incremental_metrics", """SELECT count(*) AS entrada, count(DISTINCT o_custkey) AS unicos, count(DISTINCT o_custkey) - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 64 = 1) AS nuevos,
    count(*) - (count(DISTINCT o_custkey) - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 64 = 1)) AS duplicados, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 64 = 1) AS antes FROM orders""")
def incremental_metrics(spark, sf_dir):
    orders, target = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), shared_folder(spark, "orders")
    config, output = IncrementalConfig.of({"activo": True, "claves": ["o_custkey"]}), OutputConfig.of({"modo": "append"})
    run_incremental(spark, orders.filter("o_orderkey % 64 = 1"), target, config, output)
    found = run_incremental(spark, orders, target, config, output)
    names = ("entrada", "total_registros_entrada"), ("unicos", "total_registros_unicos_lote"), ("nuevos", "total_registros_nuevos"), ("duplicados", "total_registros_duplicados"), ("antes", "total_registros_antes")
    return spark.createDataFrame([tuple(found[key] for _, key in names)], ", ".join(f"{name} long" for name, _ in names))


@direct("script_store_and_load", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey > 0")
def script_store_and_load(spark, sf_dir):
    """A script that publishes a table as one CSV of a connection, and one that loads it from there (LIB CONNECT, allow-list, types by the file)."""
    folder = shared_folder(spark, "published")
    files = [{"esquema": "", "tabla": "paises.csv", "campos": []}]
    catalog = load_catalog(json.dumps({"locales": [{"nombre": "datos", "tipo": "local", "ruta_base": folder, "allowlist": files}]}), inline=True)
    first = Executor(spark, catalog)
    first.register("nation", table(spark, sf_dir, "nation"))
    first.run(compile_script("r: LOAD n_nationkey, n_name, n_regionkey RESIDENT nation WHERE n_regionkey > 0; STORE r INTO [lib://datos/paises.csv] (csv);", TABLES))
    return Executor(spark, catalog).run(compile_script("LIB CONNECT TO 'datos'; p: LOAD n_nationkey, n_name, n_regionkey FROM [lib://datos/paises.csv];"))["p"]


@direct("jdbc_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000")
def jdbc_round_trip(spark, sf_dir):
    """A script that publishes to a database, and one that reads the table by ranges and filters it. The database is in files, closed and shared before it is read."""
    url, driver = embedded.new_database(), embedded.DRIVER
    first = Executor(spark, target=TargetDatabase.of({"url": url, "driver": driver}))
    first.register("orders", table(spark, sf_dir, "orders"))
    first.run(compile_script("r: LOAD o_orderkey, o_custkey, o_orderstatus, o_totalprice RESIDENT orders; STORE r INTO [lib://base/Pedidos.csv] (csv);", TABLES))
    url = embedded.sealed(spark, url)
    allowed = {"esquema": "", "tabla": "pedidos", "campos": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"], "particion": {"columna": "o_orderkey", "minimo": 0, "maximo": 60000, "particiones": 4}}
    catalog = load_catalog(json.dumps({"jdbc": [{"nombre": "db", "tipo": "jdbc", "url": url, "driver": driver, "allowlist": [allowed]}]}), inline=True)
    return Executor(spark, catalog).run(compile_script("LIB CONNECT TO 'db'; p: SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM pedidos WHERE o_totalprice > 100000;"))["p"]


@direct("jdbc_even_parts", """SELECT count(*) AS filas, count(DISTINCT o_orderkey) AS claves, CAST(8 AS BIGINT) AS partes, TRUE AS parejas FROM orders""")
def jdbc_even_parts(spark, sf_dir):
    """A table whose key lies densely in one corner of its range, read by eight tasks that the database's own counts make even. The database is in files, closed and shared before it is read."""
    url, driver = embedded.new_database(), embedded.DRIVER
    orders = table(spark, sf_dir, "orders").select(F.expr("CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey * 1000003 ELSE o_orderkey END AS clave"), "o_orderkey")
    TargetDatabase(url, driver).write(orders, "pedidos", Secrets())
    url = embedded.sealed(spark, url)
    allowed = {"esquema": "", "tabla": "pedidos", "campos": ["clave", "o_orderkey"], "particion": {"columna": "clave", "particiones": 8}}
    catalog = load_catalog(json.dumps({"jdbc": [{"nombre": "db", "tipo": "jdbc", "url": url, "driver": driver, "allowlist": [allowed]}]}), inline=True)
    found = Executor(spark, catalog).run(compile_script("LIB CONNECT TO 'db'; p: SELECT clave, o_orderkey FROM pedidos;"))["p"]
    parts = found.groupBy(F.spark_partition_id().alias("parte")).agg(F.count(F.lit(1)).alias("n"))
    told = parts.agg(F.sum("n").alias("filas"), F.count(F.lit(1)).alias("partes"), F.max("n").alias("most"))
    keys = found.agg(F.countDistinct("o_orderkey").alias("claves")).scalar()
    return told.select("filas", keys.alias("claves"), "partes", (F.col("most") * 8 <= F.col("filas") * 2).alias("parejas"))


@direct("sink_manifest", """SELECT 'paises.csv' AS archivo, CAST(octet_length(encode(t)) AS BIGINT) AS bytes, sha256(t) AS sha256, 'PUBLICADO' AS estado
    FROM (SELECT 'n_nationkey,n_name' || chr(10) || string_agg(n_nationkey || ',' || n_name || chr(10), '' ORDER BY n_nationkey) AS t FROM nation)""")
def sink_manifest(spark, sf_dir):
    """What the manifest of a published file says of its bytes."""
    told = publish_store(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey"), f"{shared_folder(spark, 'manifest')}/paises.csv")
    return spark.createDataFrame([(told.archivo, told.bytes, told.sha256, told.estado)], "archivo string, bytes long, sha256 string, estado string")


@direct("stream_to_csv", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view'")
def stream_events(spark, sf_dir):
    """Events as a stream to one CSV file by two runs, of which the second adds what came meanwhile; read back."""
    folder = shared_folder(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for half in ("event_id % 2 = 0", "event_id % 2 <> 0 OR event_id IS NULL"):
        events.filter(half).repartition(4).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        stream_to_csv(stream.filter("event_type <> 'view'"), f"{folder}/state", f"{folder}/events.csv")
    return read(spark, f"{folder}/events.csv", events.schema, InputConfig.of({"opciones": {"header": True}}))


@direct("stream_incremental", "SELECT o_custkey, min(o_orderkey) FILTER (o_orderkey % 2 = 0 OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)) AS o_orderkey FROM orders GROUP BY o_custkey")
def stream_orders(spark, sf_dir):
    """Orders as a stream into one target by two runs: the second adds the customers that the first lacks, each with its least order."""
    folder, orders = shared_folder(spark, "orders"), table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    config, output = IncrementalConfig.of({"activo": True, "claves": ["o_custkey"]}), OutputConfig.of({"modo": "append"})
    for half in ("o_orderkey % 2 = 0", "o_orderkey % 2 <> 0"):
        orders.filter(half).write.mode("append").parquet(f"{folder}/in")
        stream_incremental(spark.readStream.schema(orders.schema).parquet(f"{folder}/in"), f"{folder}/target", config, output, f"{folder}/state")
    return spark.read.parquet(f"{folder}/target")


@direct("incremental_pruned", "SELECT count(*) AS destino, count(*) FILTER (o_orderkey % 16 = 3) AS comunes, TRUE AS completo, TRUE AS podado FROM orders WHERE o_orderkey % 16 < 12")
def incremental_pruned(spark, sf_dir):
    """How many of a target's rows an incremental load reads past its filters: all with a key of the batch, and few others."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), shared_folder(spark, "orders")
    orders.filter("o_orderkey % 16 < 12").write.parquet(path)
    old, keys = spark.read.parquet(path), orders.filter("o_orderkey % 16 IN (3, 13)").select("o_orderkey")
    met = pruned(old, keys, ["o_orderkey"], keys.count()).withColumn("known", F.col("o_orderkey") % 16 == 3)
    common, others = met.agg(F.count_if("known"), F.count_if(~F.col("known"))).first()
    total, wanted = old.count(), old.filter("o_orderkey % 16 = 3").count()
    return spark.createDataFrame([(total, common, common == wanted, others * 20 < total)], "destino long, comunes long, completo boolean, podado boolean")


# --- dataflow scripts

script("script_distinct", "r: LOAD DISTINCT c_mktsegment AS segmento, c_nationkey RESIDENT customer;", "r", "SELECT DISTINCT c_mktsegment AS segmento, c_nationkey FROM customer")
script("script_star", "r: LOAD *, n_regionkey * 2 AS doble RESIDENT nation;", "r", "SELECT *, n_regionkey * 2.0::DOUBLE AS doble FROM nation")
script(
    "script_null_safe",
    """t: LOAD c_custkey, c_nationkey AS k RESIDENT customer;
    LEFT JOIN (t) LOAD s_nationkey AS k, Max(s_nationkey) AS m RESIDENT supplier WHERE s_nationkey < 10 GROUP BY s_nationkey;
    r: LOAD c_custkey RESIDENT t WHERE m <> 3;""",
    "r",
    """SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT s_nationkey AS m FROM supplier WHERE s_nationkey < 10) ON c_nationkey = m WHERE m IS DISTINCT FROM 3""",
)
script(
    "script_conditions", "r: LOAD l_orderkey, l_linenumber RESIDENT lineitem WHERE (l_quantity >= 10 AND NOT l_returnflag = 'N') OR l_discount < 0.01;",
    "r", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_quantity >= 10 AND NOT l_returnflag = 'N') OR l_discount < 0.01",
)
script(
    "script_match", "r: LOAD o_orderkey, Match(o_orderstatus, 'O', 'F', 'O') AS m, If(Match(o_orderstatus, 'P'), 'parcial', 'otro') AS e RESIDENT orders;",
    "r", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS m, CASE WHEN o_orderstatus = 'P' THEN 'parcial' ELSE 'otro' END AS e FROM orders",
)
script(
    "script_index_regex", "r: LOAD p_partkey, IndexRegEx(p_name, '[aeiou]+') AS uno, IndexRegEx(p_name, '[aeiou]', 2) AS dos RESIDENT part;", "r",
    """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '[aeiou]') THEN length(regexp_extract(p_name, '^[^aeiou]*')) + 1 ELSE 0 END::INTEGER AS uno,
    CASE WHEN regexp_matches(p_name, '[aeiou][^aeiou]*[aeiou]') THEN length(regexp_extract(p_name, '^[^aeiou]*[aeiou][^aeiou]*')) + 1 ELSE 0 END::INTEGER AS dos FROM part""",
)
script(
    "script_num", "r: LOAD c_custkey, Num(c_name) AS n, Num(c_mktsegment) AS cero RESIDENT customer;", "r",
    "SELECT c_custkey, coalesce(TRY_CAST(regexp_replace(c_name, '[^0-9.,-]', '', 'g') AS DOUBLE), 0.0) AS n, 0.0::DOUBLE AS cero FROM customer",
)
script(
    "script_dates", "r: LOAD o_orderkey, Year(o_orderdate) AS a, Month(o_orderdate) AS m, Day(o_orderdate) AS d, Date(o_orderdate) AS f RESIDENT orders;", "r",
    "SELECT o_orderkey, year(o_orderdate)::INTEGER AS a, month(o_orderdate)::INTEGER AS m, day(o_orderdate)::INTEGER AS d, CAST(o_orderdate AS DATE) AS f FROM orders",
)
script(
    "script_text", "r: LOAD p_partkey, Concat(Upper(p_brand), '-', Lower(p_type)) AS c, Len(p_name) AS n, Left(p_name, 3) AS i, Mid(p_name, 2, 4) AS s, Substring(p_name, 3) AS t, Trim(Concat(' ', p_brand, ' ')) AS b RESIDENT part;", "r",
    "SELECT p_partkey, upper(p_brand) || '-' || lower(p_type) AS c, length(p_name)::INTEGER AS n, left(p_name, 3) AS i, substr(p_name, 2, 4) AS s, substr(p_name, 3) AS t, p_brand AS b FROM part",
)
script(
    "script_nulls", "t: LOAD c_custkey, c_nationkey AS k RESIDENT customer; LEFT JOIN (t) LOAD s_nationkey AS k, Max(s_suppkey) AS s RESIDENT supplier WHERE s_nationkey < 10 GROUP BY s_nationkey; r: LOAD c_custkey, IsNull(s) AS nulo, Coalesce(s, c_custkey) AS v, IfNull(s, 0) AS w RESIDENT t;", "r",
    "SELECT c_custkey, CASE WHEN s IS NULL THEN -1 ELSE 0 END AS nulo, coalesce(s, c_custkey) AS v, coalesce(CAST(s AS DOUBLE), 0.0) AS w FROM customer LEFT JOIN (SELECT s_nationkey, max(s_suppkey) AS s FROM supplier WHERE s_nationkey < 10 GROUP BY s_nationkey) ON c_nationkey = s_nationkey",
)
script(
    "script_arithmetic", "r: LOAD l_orderkey, l_linenumber, -l_quantity + l_quantity * 2 - l_linenumber / 2 AS x RESIDENT lineitem;", "r",
    "SELECT l_orderkey, l_linenumber, -l_quantity + l_quantity * 2 - CAST(l_linenumber AS DOUBLE) / 2 AS x FROM lineitem",
)
script(
    "script_aggregate", "r: LOAD o_custkey AS cliente, Sum(o_orderkey) AS s, Count(*) AS n, Count(DISTINCT o_orderstatus) AS estados, Min(o_orderkey) AS menor, Max(o_orderkey) AS mayor, Avg(o_orderkey) AS media RESIDENT orders WHERE o_totalprice > 5000 GROUP BY o_custkey;", "r",
    "SELECT o_custkey AS cliente, sum(o_orderkey)::BIGINT AS s, count(*) AS n, count(DISTINCT o_orderstatus) AS estados, min(o_orderkey) AS menor, max(o_orderkey) AS mayor, avg(o_orderkey) AS media FROM orders WHERE o_totalprice > 5000 GROUP BY o_custkey",
)
script(
    "script_rank", "r: LOAD o_orderkey, o_custkey, Window(WRank(1,1), o_custkey, 'DESC', o_orderstatus) AS puesto, Window(WRank(4,1), o_custkey, 'ASC', o_totalprice, o_orderkey) AS fila RESIDENT orders;", "r",
    "SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus DESC)::INTEGER AS puesto, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey)::INTEGER AS fila FROM orders",
)
script(
    "script_preceding", "r: LOAD k, neto, iva, neto + iva AS total; LOAD k, neto, neto * 0.19 AS iva WHERE neto > 50; LOAD l_orderkey AS k, l_quantity * 2 AS neto RESIDENT lineitem;", "r",
    "SELECT l_orderkey AS k, l_quantity * 2 AS neto, l_quantity * 2 * 0.19::DOUBLE AS iva, l_quantity * 2 + l_quantity * 2 * 0.19::DOUBLE AS total FROM lineitem WHERE l_quantity * 2 > 50",
)
script(
    "script_select_join", "r: SELECT x.o_orderkey AS pedido, c_name FROM orders x LEFT JOIN customer y ON x.o_custkey = y.c_custkey GROUP BY o_orderkey, c_name WHERE o_totalprice > 1000;", "r",
    "SELECT o_orderkey AS pedido, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 1000 GROUP BY ALL",
)
script(
    "script_union_distinct", "t: LOAD c_nationkey AS k RESIDENT customer; CONCATENATE (t) LOAD s_nationkey AS k RESIDENT supplier; r: NOCONCATENATE LOAD DISTINCT k RESIDENT t; DROP TABLE t;", "r",
    "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
)
script(
    "script_null_equality", "t: LOAD c_custkey, c_nationkey AS k RESIDENT customer; LEFT JOIN (t) LOAD s_nationkey AS k, Max(s_nationkey) AS m RESIDENT supplier WHERE s_nationkey < 10 GROUP BY s_nationkey; "
    "LEFT JOIN (t) LOAD c_custkey, Max(c_nationkey) AS o RESIDENT customer WHERE c_nationkey < 5 GROUP BY c_custkey; r: LOAD c_custkey RESIDENT t WHERE m = o;", "r",
    "SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT s_nationkey AS m FROM supplier WHERE s_nationkey < 10) ON c_nationkey = m WHERE m IS NOT DISTINCT FROM (CASE WHEN c_nationkey < 5 THEN c_nationkey END)",
)
script(
    "script_functions", "r: LOAD s_suppkey, False() AS falso, IfNull(s_name, 'x') AS nombre, Text(s_nationkey) AS pais, Length(s_name) AS largo, If(False(), 1, 2) AS dos RESIDENT supplier;", "r",
    "SELECT s_suppkey, FALSE AS falso, coalesce(s_name, 'x') AS nombre, CAST(s_nationkey AS VARCHAR) AS pais, length(s_name)::INTEGER AS largo, 2.0::DOUBLE AS dos FROM supplier",
)
script(
    "script_num_signs", "r: LOAD c_custkey, Num(Concat('$ ', c_acctbal, ' COP')) AS saldo, Num(Concat('1,', c_custkey)) AS coma, Num('-') AS signo, Num('') AS vacio, Num('a1b2.5') AS junto RESIDENT customer;", "r",
    "SELECT c_custkey, c_acctbal AS saldo, 0.0::DOUBLE AS coma, 0.0::DOUBLE AS signo, 0.0::DOUBLE AS vacio, 12.5::DOUBLE AS junto FROM customer",
)
script(
    "script_regex_occurrences", "r: LOAD p_partkey, IndexRegEx(p_brand, '[0-9]', 2) AS dos, IndexRegEx(p_brand, '[0-9]', 3) AS tres, IndexRegEx(p_brand, 'zzz') AS nada RESIDENT part;", "r",
    r"""SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '[0-9][^0-9]*[0-9]') THEN length(regexp_extract(p_brand, '^[^0-9]*[0-9][^0-9]*')) + 1 ELSE 0 END::INTEGER AS dos,
    CASE WHEN regexp_matches(p_brand, '[0-9][^0-9]*[0-9][^0-9]*[0-9]') THEN length(regexp_extract(p_brand, '^[^0-9]*[0-9][^0-9]*[0-9][^0-9]*')) + 1 ELSE 0 END::INTEGER AS tres, 0::INTEGER AS nada FROM part""",
)
script("script_plain_keys", "r: LOAD c_nationkey, c_mktsegment AS segmento RESIDENT customer GROUP BY c_nationkey, c_mktsegment;", "r", "SELECT DISTINCT c_nationkey, c_mktsegment AS segmento FROM customer")
script("script_distinct_groups", "r: LOAD DISTINCT c_nationkey, Count(*) AS n RESIDENT customer GROUP BY c_nationkey;", "r", "SELECT DISTINCT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey")
script("script_resident_filter", "r: RESIDENT nation, n_regionkey = 2;", "r", "SELECT * FROM nation WHERE n_regionkey = 2")
_RULE = "l_quantity > 0 AND IndexRegEx(l_returnflag, '[AR]') > 0"
script("script_accepted", f"r: LOAD l_orderkey, l_linenumber RESIDENT lineitem WHERE {_RULE};", "r", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 0 AND regexp_matches(l_returnflag, '[AR]')")
script("script_rejected", f"r: LOAD l_orderkey, l_linenumber RESIDENT lineitem WHERE NOT ({_RULE});", "r", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity > 0 AND regexp_matches(l_returnflag, '[AR]'))")



@direct("script_rank_global", """SELECT l_orderkey, l_linenumber, rank() OVER (ORDER BY l_quantity DESC)::INTEGER AS puesto, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber)::INTEGER AS fila,
    rank() OVER (PARTITION BY l_linestatus ORDER BY l_shipdate, l_quantity)::INTEGER + 1.0::DOUBLE AS siguiente FROM lineitem""")
def script_rank_global(spark, sf_dir):
    """Ranks over the whole table and over partitions that are taken for too large; lines of one quantity have one rank."""
    executor = Executor(spark, hot_rows=1000)
    executor.register("lineitem", table(spark, sf_dir, "lineitem"))
    text = """r: LOAD l_orderkey, l_linenumber, Window(WRank(1,1), 'DESC', l_quantity) AS puesto, Window(WRank(4,1), 'ASC', l_extendedprice, l_orderkey, l_linenumber) AS fila,
        Window(WRank(1,1), l_linestatus, 'ASC', l_shipdate, l_quantity) + 1 AS siguiente RESIDENT lineitem;"""
    return executor.run(compile_script(text, TABLES))["r"]


@direct("join_heavy_keys", """SELECT clave, l_orderkey, l_linenumber, s_name, s_nationkey, t FROM (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 1 WHEN l_orderkey % 7 <> 0 THEN l_suppkey END AS clave, l_orderkey, l_linenumber FROM lineitem)
    LEFT JOIN (SELECT s_suppkey AS clave, s_name, s_nationkey FROM supplier) USING (clave) LEFT JOIN (SELECT n_nationkey AS s_nationkey, n_name AS t FROM nation) USING (s_nationkey)""")
def join_heavy_keys(spark, sf_dir):
    """Two joins in which one key has half of the rows, and others have none."""
    executor = Executor(spark, skew_share=0.05)
    key = F.expr("CASE WHEN l_orderkey % 2 = 0 THEN 1 WHEN l_orderkey % 7 <> 0 THEN l_suppkey END")
    executor.register("lineas", table(spark, sf_dir, "lineitem").select(key.alias("clave"), "l_orderkey", "l_linenumber"))
    for t in ("supplier", "nation"):
        executor.register(t, table(spark, sf_dir, t))
    text = """LEFT JOIN (lineas) LOAD s_suppkey AS clave, s_name, s_nationkey RESIDENT supplier; LEFT JOIN (lineas) LOAD n_nationkey AS s_nationkey, n_name AS t RESIDENT nation;
        r: LOAD clave, l_orderkey, l_linenumber, s_name, s_nationkey, t RESIDENT lineas;"""
    return executor.run(compile_script(text, (*TABLES, "lineas")))["r"]


#: The flagship: load, clean, five joins with renamed columns, arithmetic layers, rank, and a summary.
MART = """
SET version = '1';
ventas: LOAD l_orderkey AS pedido, l_partkey AS producto, l_suppkey AS proveedor, l_linenumber AS linea, l_quantity AS cantidad,
    l_extendedprice AS bruto, l_discount AS descuento, l_tax AS impuesto RESIDENT lineitem WHERE l_quantity > 1 AND NOT IsNull(l_shipdate);
LEFT JOIN (ventas) LOAD o_orderkey AS pedido, o_custkey AS cliente, Year(o_orderdate) AS anio, Month(o_orderdate) AS mes RESIDENT orders;
LEFT JOIN (ventas) LOAD c_custkey AS cliente, c_nationkey AS pais_id, Trim(c_mktsegment) AS segmento RESIDENT customer;
LEFT JOIN (ventas) LOAD n_nationkey AS pais_id, n_name AS pais, n_regionkey AS region_id RESIDENT nation;
LEFT JOIN (ventas) LOAD r_regionkey AS region_id, r_name AS region RESIDENT region;
LEFT JOIN (ventas) LOAD p_partkey AS producto, p_brand AS marca RESIDENT part;
detalle: LOAD *, Window(WRank(1,1), region, anio, mes, 'DESC', total) AS puesto;
LOAD *, neto + neto * impuesto AS total;
LOAD *, bruto - bruto * descuento AS neto RESIDENT ventas;
DROP TABLE ventas;
resumen: LOAD region, anio, segmento, Count(*) AS lineas, Count(DISTINCT cliente) AS clientes, Sum(cantidad) AS unidades, Max(puesto) AS ultimo,
    Sum(total) AS total RESIDENT detalle GROUP BY region, anio, segmento;
"""
MART_SQL = """
WITH d AS (
  SELECT r_name AS region, year(o_orderdate) AS anio, month(o_orderdate) AS mes, trim(c_mktsegment) AS segmento, o_custkey, l_quantity,
    (l_extendedprice - l_extendedprice * l_discount) + (l_extendedprice - l_extendedprice * l_discount) * l_tax AS total
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey WHERE l_quantity > 1 AND l_shipdate IS NOT NULL
), k AS (SELECT *, rank() OVER (PARTITION BY region, anio, mes ORDER BY total DESC) AS puesto FROM d)
SELECT region, anio::INTEGER AS anio, segmento, count(*) AS lineas, count(DISTINCT o_custkey) AS clientes, sum(l_quantity) AS unidades, max(puesto)::INTEGER AS ultimo, round(sum(total), 2) AS total
FROM k GROUP BY region, anio, segmento
"""


@direct("script_mart", MART_SQL)
def script_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    executor = Executor(spark)
    for t in TABLES:
        executor.register(t, table(spark, sf_dir, t))
    return executor.run(compile_script(MART, TABLES))["resumen"].withColumn("total", F.round("total", 2))


#: A nightly load: seven relational sources, orders of two periods put together, cleaning in layers, ranks, accepted and rejected lines, four tables published to a database.
WAREHOUSE = """
SET proceso = 'nocturno';
LIB CONNECT TO 'almacen';
paises: LOAD n_nationkey AS pais_id, Upper(Trim(n_name)) AS pais, n_regionkey AS region_id; SELECT n_nationkey, n_name, n_regionkey FROM nation;
LEFT JOIN (paises) LOAD r_regionkey AS region_id, r_name AS region; SELECT r_regionkey, r_name FROM region;
clientes: LOAD cliente, segmento, pais_id, If(saldo < 0, 'deudor', 'normal') AS estado;
LOAD c_custkey AS cliente, Coalesce(Trim(c_mktsegment), 'SIN') AS segmento, c_nationkey AS pais_id, c_acctbal AS saldo; SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal FROM customer;
LEFT JOIN (clientes) LOAD pais_id, pais, region RESIDENT paises;
proveedores: LOAD s_suppkey AS proveedor, s_name AS razon, s_nationkey AS origen_id, Num(Concat('$', s_acctbal)) AS saldo_proveedor; SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier;
LEFT JOIN (proveedores) LOAD pais_id AS origen_id, pais AS origen RESIDENT paises;
productos: LOAD DISTINCT p_partkey AS producto, p_brand AS marca, IndexRegEx(p_name, '[aeiou]') AS vocal; SELECT p_partkey, p_name, p_brand FROM part;
pedidos: LOAD o_orderkey AS pedido, o_custkey AS cliente, o_orderdate AS fecha, Match(o_orderstatus, 'O', 'F', 'P') AS fase; SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM pedidos_viejos;
CONCATENATE (pedidos) LOAD o_orderkey AS pedido, o_custkey AS cliente, o_orderdate AS fecha, Match(o_orderstatus, 'O', 'F', 'P') AS fase; SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM pedidos_nuevos;
lineas: LOAD l_orderkey AS pedido, l_linenumber AS linea, l_partkey AS producto, l_suppkey AS proveedor, l_quantity AS cantidad, l_extendedprice AS bruto, l_discount AS descuento, l_returnflag AS devuelta RESIDENT lineitem;
LEFT JOIN (lineas) LOAD pedido, cliente, Year(fecha) AS anio, fase RESIDENT pedidos;
LEFT JOIN (lineas) LOAD cliente, segmento, estado, region RESIDENT clientes;
LEFT JOIN (lineas) LOAD proveedor, origen, saldo_proveedor RESIDENT proveedores;
LEFT JOIN (lineas) LOAD producto, marca, vocal RESIDENT productos;
detalle: LOAD *, Window(WRank(1,1), region, anio, 'DESC', neto) AS puesto;
LOAD *, bruto - bruto * descuento AS neto RESIDENT lineas;
DROP TABLE lineas;
aceptadas: LOAD * RESIDENT detalle WHERE cantidad > 2 AND vocal > 0 AND NOT (devuelta = 'R' AND estado = 'deudor');
rechazadas: LOAD pedido, linea, cantidad, devuelta, estado RESIDENT detalle WHERE NOT (cantidad > 2 AND vocal > 0 AND NOT (devuelta = 'R' AND estado = 'deudor'));
resumen: LOAD region, anio, segmento, fase, Count(*) AS lineas, Count(DISTINCT cliente) AS clientes, Count(DISTINCT origen) AS origenes, Max(puesto) AS ultimo, Sum(neto) AS total RESIDENT aceptadas GROUP BY region, anio, segmento, fase;
marcas: LOAD marca, Sum(cantidad) AS unidades, Min(saldo_proveedor) AS menor RESIDENT aceptadas GROUP BY marca;
STORE resumen INTO [lib://salida/Resumen.csv] (csv);
STORE marcas INTO [lib://salida/Marcas.csv] (csv);
STORE rechazadas INTO [lib://salida/Rechazadas.csv] (csv);
STORE clientes INTO [lib://salida/Clientes.csv] (csv);
DROP TABLE detalle;
"""
WAREHOUSE_SQL = """
WITH lineas AS (
  SELECT r_name AS region, year(o_orderdate) AS anio, trim(c_mktsegment) AS segmento, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 0 END AS fase, o_custkey, upper(trim(sn.n_name)) AS origen,
    l_extendedprice - l_extendedprice * l_discount AS neto, l_quantity, coalesce(l_quantity > 2 AND regexp_matches(p_name, '[aeiou]') AND NOT (l_returnflag = 'R' AND c_acctbal < 0), FALSE) AS buena, p_brand, s_acctbal
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation n ON c_nationkey = n.n_nationkey LEFT JOIN region ON n.n_regionkey = r_regionkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN part ON l_partkey = p_partkey
), detalle AS (SELECT *, rank() OVER (PARTITION BY region, anio ORDER BY neto DESC) AS puesto FROM lineas), aceptadas AS (SELECT * FROM detalle WHERE buena)
SELECT 'resumen' AS tabla, region, anio::INTEGER AS anio, segmento, fase::INTEGER AS fase, count(*) AS lineas, count(DISTINCT o_custkey) AS clientes, count(DISTINCT origen) AS origenes, max(puesto)::INTEGER AS ultimo, round(sum(neto), 4) AS total FROM aceptadas GROUP BY region, anio, segmento, fase
UNION ALL SELECT 'marcas', p_brand, NULL, NULL, NULL, NULL, NULL, NULL, NULL, round(sum(l_quantity) + min(s_acctbal), 4) FROM aceptadas GROUP BY p_brand
UNION ALL SELECT 'rechazadas', NULL, NULL, NULL, NULL, count(*), NULL, NULL, NULL, sum(l_quantity) FROM detalle WHERE NOT buena
UNION ALL SELECT 'clientes', NULL, NULL, NULL, NULL, count(*) FILTER (c_acctbal < 0), count(*), NULL, NULL, NULL FROM customer
"""


@direct("script_warehouse", WAREHOUSE_SQL)
def script_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole nightly load, and what its four published tables hold when they are read back. Both databases are in files, closed and shared before they are read."""
    url, target, driver = embedded.new_database(), embedded.new_database(), embedded.DRIVER
    sources = {t: table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "part")}
    orders = table(spark, sf_dir, "orders")
    sources |= {"pedidos_viejos": orders.filter("o_orderdate < '1998-07-01'"), "pedidos_nuevos": orders.filter("o_orderdate >= '1998-07-01'")}
    for name, df in sources.items():
        TargetDatabase(url, driver).write(df, name, Secrets())
    url = embedded.sealed(spark, url)
    split = {"pedidos_viejos": {"columna": "o_orderkey", "particiones": 4}, "pedidos_nuevos": {"columna": "o_orderkey", "particiones": 4}}
    allowed = [{"esquema": "", "tabla": t, "campos": df.columns} | ({"particion": split[t]} if t in split else {}) for t, df in sources.items()]
    catalog = load_catalog(json.dumps({"jdbc": [{"nombre": "almacen", "tipo": "jdbc", "url": url, "driver": driver, "allowlist": allowed}]}), inline=True)
    executor = Executor(spark, catalog, target=TargetDatabase.of({"url": target, "driver": driver}))
    executor.register("lineitem", table(spark, sf_dir, "lineitem"))
    executor.run(compile_script(WAREHOUSE, ("lineitem",)))
    executor.release()
    url = embedded.sealed(spark, target)
    back = lambda name: spark.read.format("jdbc").options(url=url, driver=driver, dbtable=f'"{name}"').load()
    told = [
        back("resumen").withColumns({"tabla": F.lit("resumen"), "total": F.round("total", 4)}),
        back("marcas").select(F.lit("marcas").alias("tabla"), F.col("marca").alias("region"), F.round(F.col("unidades") + F.col("menor"), 4).alias("total")),
        back("rechazadas").agg(F.count(F.lit(1)).alias("lineas"), F.sum("cantidad").alias("total")).withColumn("tabla", F.lit("rechazadas")),
        back("clientes").agg(F.count_if(F.col("estado") == "deudor").alias("lineas"), F.count(F.lit(1)).alias("clientes")).withColumn("tabla", F.lit("clientes")),
    ]
    out = told[0]
    for df in told[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.select("tabla", "region", "anio", "segmento", "fase", "lineas", "clientes", "origenes", "ultimo", "total")
