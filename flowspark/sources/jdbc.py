"""JDBC scans and sinks; Spark pushes filters and columns into the subquery."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import FlowError
from ..types import column
from .catalog import Catalog, JdbcConnection, Secrets, expand, safe_for_sql
from .embedded import IN_FILES, bulk_load, full_pages, table_exists

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
MAX_IDENTIFIER = 128
#: Words that may not be identifiers, and options that only this module sets.
RESERVED = set("SELECT FROM WHERE INSERT UPDATE DELETE DROP CREATE ALTER TABLE UNION JOIN GRANT EXEC EXECUTE".split())
OWN_OPTIONS = {"url", "user", "password", "driver", "dbtable", "query"}
#: Driver class to Maven coordinates.
PACKAGES = {
    "org.postgresql.Driver": "org.postgresql:postgresql:42.7.7",
    "com.microsoft.sqlserver.jdbc.SQLServerDriver": "com.microsoft.sqlserver:mssql-jdbc:12.8.1.jre11",
    "com.mysql.cj.jdbc.Driver": "com.mysql:mysql-connector-j:8.4.0",
    "org.mariadb.jdbc.Driver": "org.mariadb.jdbc:mariadb-java-client:3.5.2",
}
MODES = {"append", "overwrite", "error", "errorifexists", "ignore"}


def identifier(name: str, what: str) -> str:
    if not IDENTIFIER.fullmatch(name or "") or len(name) > MAX_IDENTIFIER or name.upper() in RESERVED:
        raise FlowError(f"{what} inválido: {name!r}", f"JDBC_INVALID_ID_{what.upper()}")
    return f'"{name}"'


def subquery(schema: str | None, table: str, columns: list[str]) -> str:
    if not columns:
        raise FlowError("Faltan columnas", "JDBC_COLUMNAS_REQUERIDAS")
    source = ".".join(([identifier(schema, "esquema")] if schema else []) + [identifier(table, "tabla")])
    return f"SELECT {', '.join(identifier(c, 'columna') for c in columns)} FROM {source}"


def credentials(connection: JdbcConnection, secrets: Secrets) -> dict[str, str]:
    if not connection.secret:
        return {}
    user, colon, password = secrets.require(connection.secret).partition(":")
    if not colon or not user:
        raise FlowError(f"El secreto {connection.secret} no es usuario:clave", "SECRET_INVALID")
    return {"user": user, "password": password}


def split_options(split: dict | None, allowed: tuple[str, ...]) -> dict[str, str]:
    """How a table is read by many tasks: by ranges of a column between two bounds; without a split one task reads it."""
    if not split or measured_split(split, allowed):
        return {}
    wanted = {"partitionColumn": "columna", "lowerBound": "minimo", "upperBound": "maximo", "numPartitions": "particiones"}
    if missing := [key for key in wanted.values() if split.get(key) is None]:
        raise FlowError(f"La partición necesita {missing}", "JDBC_PARTITION_INVALID")
    out = {option: str(split[key]) for option, key in wanted.items()}
    identifier(out["partitionColumn"], "columna")
    if allowed and out["partitionColumn"] not in allowed or not out["numPartitions"].isdigit() or out["numPartitions"] == "0":
        raise FlowError("Partición inválida", "JDBC_PARTITION_INVALID")
    for bound in ("lowerBound", "upperBound"):
        safe_for_sql(out[bound])
    return out


def measured_split(split: dict | None, allowed: tuple[str, ...]) -> tuple[str, int] | None:
    """The column and the number of parts of a split without bounds, whose parts are measured in the database."""
    if not split or split.get("minimo") is not None or split.get("maximo") is not None or split.get("columna") is None:
        return None
    name, n = str(split["columna"]), str(split.get("particiones") or "")
    identifier(name, "columna")
    if allowed and name not in allowed or not n.isdigit() or n == "0":
        raise FlowError("Partición inválida", "JDBC_PARTITION_INVALID")
    return name, int(n)


#: Cells that a range is cut into at a time; a result has so many rows at most.
CELLS = 256


def cells_of(ask: Callable[[str], list], source: str, name: str, n: int) -> tuple[list[tuple[int, int]], int]:
    """(first value, rows) of cells in order that hold no more than half of an even part, or one value; and all rows with a value.

    ask runs a query in the database, which counts by cells of equal width; only cells that are too full are cut again.
    """
    column_ = identifier(name, "columna")
    least, most, total = ask(f"SELECT MIN({column_}) AS a, MAX({column_}) AS b, COUNT({column_}) AS n FROM {source}")[0]
    if least is None:
        return [], 0
    if any(x != int(x) for x in (least, most)):
        raise FlowError("Solo se reparte por columnas enteras", "JDBC_PARTITION_INVALID")
    room = max(1, int(total) // (2 * n))
    out, open_ = [], [(int(least), int(most), int(total))]
    while open_:
        low, high, rows = open_.pop()
        if rows <= room or low == high:
            out.append((low, rows))
            continue
        width = -(-(high - low + 1) // CELLS)
        cell = f"FLOOR(({column_} - {low}) / {width})"
        found = ask(f"SELECT c, COUNT(*) AS n FROM (SELECT {cell} AS c FROM {source} WHERE {column_} >= {low} AND {column_} <= {high}) AS cells GROUP BY c")
        open_ += [(low + int(c) * width, min(high, low + int(c) * width + width - 1), int(k)) for c, k in found]
    return sorted(out), int(total)


def even_predicates(cells: list[tuple[int, int]], total: int, name: str, n: int) -> list[str]:
    """Conditions that take each row once, each of them about as many rows; a value that holds more is a part of its own. Rows that come meanwhile are in one of them too."""
    column_ = identifier(name, "columna")
    starts, before, part = [], 0, -1
    for first, rows in cells:
        middle = (before + rows // 2) * n // total  # the even part that the middle of the cell is in
        if middle > part:
            starts.append(first)
            part = middle
        before += rows
    if len(starts) < 2:
        return ["1 = 1"]
    inner = [f"{column_} >= {a} AND {column_} < {b}" for a, b in zip(starts[1:], starts[2:], strict=False)]
    return [f"{column_} < {starts[1]} OR {column_} IS NULL", *inner, f"{column_} >= {starts[-1]}"]


def scan_measured(spark: SparkSession, connection: JdbcConnection, schema: str | None, table: str, columns: tuple[str, ...], name: str, n: int, secrets: Secrets) -> DataFrame:
    """The table by n tasks with about as many rows each, by predicates from the rows' counts in the database."""
    options = scan_options(connection, schema, table, columns, secrets)
    chosen = list(connection.tables.get(f"{schema}.{table}" if schema else table, connection.tables.get(table))) if tuple(columns) == ("*",) else list(columns)
    source = f"({subquery(schema, table, [*dict.fromkeys([*chosen, name])])}) AS flow_source"
    ask = lambda sql: [tuple(r) for r in spark.read.format("jdbc").options(**options | {"dbtable": f"({sql}) AS flow_counts"}).load().collect()]  # noqa: E731  a row, or CELLS at most
    cells, total = cells_of(ask, source, name, n)
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], source, predicates=even_predicates(cells, total, name, n), properties=rest).select(*map(column, chosen))


def scan_options(connection: JdbcConnection, schema: str | None, table: str, columns: tuple[str, ...], secrets: Secrets) -> dict[str, str]:
    allowed = connection.tables.get(f"{schema}.{table}" if schema else table, connection.tables.get(table))
    if allowed is None:
        raise FlowError(f"Tabla fuera de la lista: {table}", "TABLE_NOT_ALLOWED")
    chosen = list(allowed) if tuple(columns) == ("*",) else list(columns)
    outside = [c for c in chosen if allowed and c not in allowed]
    if outside:
        raise FlowError(f"Columnas fuera de la lista: {outside}", "COLUMN_NOT_ALLOWED")
    bad = {k for k in connection.options if k.lower() in OWN_OPTIONS}
    if bad:
        raise FlowError(f"Opciones reservadas: {sorted(bad)}", "OPTION_RESERVED")
    options = {k: str(v) for k, v in connection.options.items()}
    options |= split_options(connection.splits.get(table), allowed)
    options |= {"url": expand(connection.url), "dbtable": f"({subquery(schema, table, chosen)}) AS flow_source"}
    if connection.driver:
        options["driver"] = connection.driver
    return options | credentials(connection, secrets)


def scan(spark: SparkSession, catalog: Catalog, name: str, schema: str | None, table: str, columns: tuple[str, ...], secrets: Secrets) -> DataFrame:
    connection = catalog.get(name, JdbcConnection)
    options = scan_options(connection, schema, table, columns, secrets)
    split = measured_split(connection.splits.get(table), connection.tables.get(f"{schema}.{table}" if schema else table, connection.tables.get(table)))
    if split:
        return scan_measured(spark, connection, schema, table, columns, *split, secrets)
    return spark.read.format("jdbc").options(**options).load()


def package_of(driver: str | None) -> str:
    if driver not in PACKAGES:
        raise FlowError(f"Driver fuera de la lista: {driver}", "DRIVER_NOT_ALLOWED")
    return PACKAGES[driver]


def packages(catalog: Catalog, target: TargetDatabase | None = None) -> tuple[str, ...]:
    """The Maven packages that the catalog's connections and the target need, each once, to be known before Spark starts.

    A catalog names drivers, never packages; each of its drivers must be on the list, the target's may come from elsewhere.
    """
    found = [package_of(c.driver) for c in catalog.connections.values() if isinstance(c, JdbcConnection)]
    if target and target.driver in PACKAGES:
        found.append(PACKAGES[target.driver])
    return tuple(dict.fromkeys(found))


@dataclass(frozen=True)
class TargetDatabase:
    """The database that every STORE goes to, if one is given."""

    url: str
    driver: str
    secret: str | None = None
    schema: str | None = None
    mode: str = "overwrite"

    @classmethod
    def of(cls, doc: dict) -> TargetDatabase:
        mode = str(doc.get("modo") or doc.get("save_mode") or "overwrite").lower()
        url = doc.get("url") or doc.get("jdbc_url")
        if not url and doc.get("host"):
            database = doc.get("database") or doc.get("db") or doc.get("base_datos")
            url = f"jdbc:postgresql://{doc['host']}:{doc.get('puerto') or doc.get('port') or 5432}/{database}" if database else None
        if mode not in MODES or not url:
            raise FlowError("Base destino inválida", "TARGET_INVALID")
        driver = doc.get("driver") or "org.postgresql.Driver"
        return cls(url, driver, doc.get("secreto_nombre") or doc.get("secreto"), doc.get("schema") or doc.get("esquema"), mode)

    def options(self, table: str, secrets: Secrets) -> dict[str, str]:
        name = ".".join(([identifier(self.schema, "esquema")] if self.schema else []) + [identifier(table, "tabla")])
        return {"url": expand(self.url), "driver": self.driver, "dbtable": name} | credentials(JdbcConnection("destino", self.url, self.driver, self.secret, {}), secrets)

    def write(self, df: DataFrame, table: str, secrets: Secrets) -> None:
        """By the tasks' own connections; a database in files, which only the driver's JVM has open, takes the rows from files that tasks write."""
        options = self.options(table, secrets)
        if not IN_FILES.match(options["url"]):
            df.write.format("jdbc").mode(self.mode).options(**options).save()
        elif self.mode != "ignore" or not table_exists(df.sparkSession, options["url"], table):
            with full_pages(df.sparkSession, options["url"]):
                df.filter(F.lit(False)).write.format("jdbc").mode(self.mode).options(**options).save()  # the table, by the driver
            bulk_load(df, options["url"], self.schema, table)


def table_name(target: str) -> str:
    """A table's name from a file's."""
    stem = re.sub(r"[^A-Za-z0-9_]+", "_", target.rsplit("/", 1)[-1].rsplit(".", 1)[0]).strip("_").lower()
    return f"t_{stem}" if not stem or stem[0].isdigit() else stem
