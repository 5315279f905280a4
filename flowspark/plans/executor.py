"""Plans to DataFrames. Tables are lazy; only publishing runs jobs."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import FlowError
from ..functions.exprs import COLUMN, STAR, WINDOW, Node, Ranking, lower, predicate, ranking
from ..operators.ranking import with_rank
from ..operators.relational import concatenate, equi_join, join_keys, metric_text, natural_join
from ..operators.rounds import ROUND_ROWS, settings, stored, stored_by_slices
from ..sinks.publish import Staging, publish_local, publish_sftp, publish_store
from ..sinks.store import remove
from ..sources.catalog import Catalog, LocalConnection, Secrets, SftpConnection, place_of, relative, split_uri
from ..sources.jdbc import TargetDatabase, scan, table_name
from ..sources.reader import read_csv
from ..types import column
from .ops import Aggregate, Concat, Drop, Filter, Join, LoadCsv, LoadLocal, Op, Plan, Project, Publish, ReadJdbc, Selected, reads, writes

MAX_CONDITION = 10_000


def feeds(plan: Plan) -> dict[int, int]:
    """How many publications each operation's result reaches."""
    made: dict[str, set[int]] = {}  # table: operations that it stands on
    counts: dict[int, int] = {}
    for i, op in enumerate(plan.operaciones):
        below = set().union(*(made.get(t, set()) for t in reads(op)))
        if isinstance(op, Publish):
            for j in below:
                counts[j] = counts.get(j, 0) + 1
        elif isinstance(op, Drop):
            made.pop(op.nombre, None)
        else:
            made[writes(op)] = below | {i}
    return counts


def reused(plan: Plan) -> set[int]:
    """Operations worth keeping in memory: the last ones that several publications share, per path.

    An operation that feeds k publications is kept if something that it feeds reaches fewer of them.
    """
    counts = feeds(plan)
    out, last = set(), {}
    for i, op in enumerate(plan.operaciones):
        for t in reads(op):
            j = last.get(t)
            if j is not None and counts.get(j, 0) > 1 and (isinstance(op, Publish) or counts.get(i, 0) < counts[j]):
                out.add(j)
        if not isinstance(op, (Publish, Drop)):
            last[writes(op)] = i
    return {i for i in out if not isinstance(plan.operaciones[i], (ReadJdbc, LoadCsv, LoadLocal))}


def ranks_in(node: Node) -> list[Ranking]:
    return [ranking(node)] if node.kind == WINDOW else [r for c in node.children for r in ranks_in(c)]


@dataclass(frozen=True)
class Made:
    """What a table stands on."""

    folders: frozenset[str] = frozenset()  # stored tables
    work: bool = False  # more than a scan of files, whose rows are filtered and projected
    keys: tuple[str, ...] = ()  # of its first join; by these its rows are dealt to rounds
    rounds: int = 0  # 0 before a join


@dataclass
class Executor:
    spark: SparkSession
    catalog: Catalog = field(default_factory=lambda: Catalog({}))
    secrets: Secrets = field(default_factory=Secrets)
    target: TargetDatabase | None = None
    staging_root: str | None = None
    hot_rows: int | None = None  # partitions with more rows are ranked by many tasks; one job for each rank looks for them
    skew_share: float | None = None  # keys with so much of a join's left side are split; one job for each join looks for them
    round_rows: int = ROUND_ROWS  # what several publications share is joined and stored so many rows of the left side at a time
    tables: dict[str, DataFrame] = field(default_factory=dict)
    made: dict[str, Made] = field(default_factory=dict)
    folders: set[str] = field(default_factory=set)
    published: list[dict] = field(default_factory=list)
    done: int = 0

    def register(self, name: str, df: DataFrame, replace: bool = False) -> None:
        if name in self.tables and not replace:
            raise FlowError(f"La tabla {name} ya existe", "TABLE_EXISTS")
        self.tables[name] = df

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise FlowError(f"La tabla {name} no existe", "TABLE_NOT_FOUND")
        return self.tables[name]

    def run(self, plan: Plan) -> dict[str, DataFrame]:
        """Runs all operations in order and stops at the first error; returns the live tables.

        What several publications share is stored in the shared folder, until no live table reads it or release() is called.
        """
        keep, counts = reused(plan), feeds(plan)
        staging = Staging(self.staging_root)
        try:
            for i, op in enumerate(plan.operaciones):
                shared = counts.get(i, 0) > 1
                if shared:
                    self.prepare(op)
                self.apply(op, staging, plan.ids[i], shared)
                if i in keep and not (self.made[writes(op)].folders and not self.made[writes(op)].work):
                    self.store(writes(op))
                self.forget()
                self.done += 1
        except BaseException:
            self.release()
            raise
        finally:
            staging.remove()
        return self.tables

    def store(self, name: str) -> None:
        """Write a table, in rounds if it is long, and read it from there from now on."""
        made = self.made.get(name, Made())
        self.keep(name, *stored(self.tables[name], "stored", made.keys, max(1, made.rounds)))

    def keep(self, name: str, df: DataFrame, folder: str) -> None:
        self.tables[name], self.made[name] = df, Made(frozenset({folder}))
        self.folders.add(folder)

    def forget(self) -> None:
        """Delete the stored tables that no live table reads."""
        live = frozenset().union(*(self.made.get(t, Made()).folders for t in self.tables))
        for folder in self.folders - live:
            remove(self.spark, folder)
        self.folders &= live

    def release(self) -> None:
        """Delete all stored tables. Live tables that read them can't be used any more."""
        for folder in self.folders:
            remove(self.spark, folder)
        self.folders.clear()

    def prepare(self, op: Op) -> None:
        """Before an operation that several publications share: long tables get their rounds with their first join; they are stored where an operation needs all rounds at once."""
        if isinstance(op, Join):
            left, made = op.tabla_izquierda, self.made.get(op.tabla_izquierda, Made())
            if not made.rounds:
                made = replace(made, keys=join_keys(self.table(left), self.table(op.tabla_derecha), op.condicion_on), rounds=max(1, -(-self.table(left).count() // self.round_rows)))
                if made.rounds > 1 and made.work:  # each round reads it
                    self.store(left)
                self.made[left] = replace(self.made.get(left, Made()), keys=made.keys, rounds=made.rounds)
            if made.rounds > 1 and self.made.get(op.tabla_derecha, Made()).work:
                self.store(op.tabla_derecha)
        elif isinstance(op, (Aggregate, Concat)) or isinstance(op, Project) and (not self.slices(op) if self.ranks(op) else self.keys_after(op) is None):
            for t in reads(op):
                if self.made.get(t, Made()).rounds > 1:
                    self.store(t)

    @staticmethod
    def ranks(op: Project) -> list[Ranking]:
        return [r for s in op.selecciones for r in ranks_in(s.expression)]

    def slices(self, op: Project) -> list[Node]:
        """What all partitions of an operation's ranks have in common, so that they can be ranked a slice at a time; nothing if they can't."""
        first, *rest = self.ranks(op)
        return [n for n in first.partition if all(n in r.partition for r in rest)] if self.hot_rows is None and not op.distinct else []

    def keys_after(self, op: Project) -> tuple[str, ...] | None:
        """The names of the keys by which rows are dealt to rounds after a projection, or None if it leaves one out."""
        keys = self.made.get(op.tabla_origen, Made()).keys
        if not op.selecciones:
            names = {k: dict(op.aliases).get(k, k) for k in keys if op.campos == ("*",) or k in op.campos}
        else:
            names = {k: k for k in keys} if any(s.expression.kind == STAR for s in op.selecciones) else {}
            names |= {s.expression.value: s.name for s in op.selecciones if s.expression.kind == COLUMN and s.expression.value not in names}
        return tuple(names[k] for k in keys) if all(k in names for k in keys) else None

    def made_by(self, op: Op) -> Made:
        """What an operation's result stands on."""
        below = [self.made.get(t, Made()) for t in reads(op)]
        found = Made(frozenset().union(*(m.folders for m in below)), any(m.work for m in below))
        if isinstance(op, (Filter, Join, LoadLocal)):
            found = replace(found, keys=below[0].keys, rounds=below[0].rounds)
        elif isinstance(op, Project) and (keys := self.keys_after(op)):
            found = replace(found, keys=keys, rounds=below[0].rounds)
        own = isinstance(op, (ReadJdbc, LoadCsv, Join, Aggregate, Concat)) or isinstance(op, LoadLocal) and op.ruta not in self.tables or isinstance(op, Project) and (op.distinct or bool(self.ranks(op)))
        return replace(found, work=found.work or own)

    def apply(self, op: Op, staging: Staging, key: str, shared: bool = False) -> None:
        name, made = writes(op), None if isinstance(op, (Drop, Publish)) else self.made_by(op)
        if isinstance(op, ReadJdbc):
            self.register(op.nombre_tabla, scan(self.spark, self.catalog, op.conexion_nombre, op.esquema, op.tabla, op.campos, self.secrets))
        elif isinstance(op, LoadCsv):
            self.register(op.nombre_tabla, self.load_uri(op.ruta, op.tiene_header, op.delimitador))
        elif isinstance(op, LoadLocal):
            if op.ruta in self.tables:
                self.register(op.nombre_tabla, self.tables[op.ruta])
            else:
                self.register(op.nombre_tabla, self.load_uri(op.ruta) if op.ruta.startswith("lib://") else read_csv(self.spark, relative(op.ruta)))
        elif isinstance(op, Project):
            df, below = self.table(op.tabla_origen), self.made.get(op.tabla_origen, Made())
            if shared and below.rounds > 1 and self.ranks(op):
                self.keep(name, *stored_by_slices(df, "ranked", below.keys, below.rounds, [lower(n) for n in self.slices(op)], lambda rows: self.project(rows, op)))
                made = self.made[name]
            else:
                self.register(name, self.project(df, op), replace=True)
        elif isinstance(op, Filter):
            self.register(op.tabla_origen, self.filter(self.table(op.tabla_origen), op), replace=True)
        elif isinstance(op, Concat):
            self.register(op.tabla_objetivo, concatenate(self.table(op.tabla_objetivo), self.table(op.tabla_origen)), replace=True)
        elif isinstance(op, Join):
            left, right = self.table(op.tabla_izquierda), self.table(op.tabla_derecha)
            natural = op.condicion_on.upper() == "NATURAL"
            joined = natural_join(left, right, op.tipo_join, self.skew_share) if natural else equi_join(left, right, op.condicion_on, op.tipo_join, self.skew_share)
            self.register(op.tabla_izquierda, joined, replace=True)
        elif isinstance(op, Aggregate):
            self.register(op.tabla_resultado or op.tabla_origen, self.aggregate(self.table(op.tabla_origen), op), replace=True)
        elif isinstance(op, Drop):
            self.table(op.nombre)
            del self.tables[op.nombre]
            self.made.pop(op.nombre, None)
        else:
            with settings(self.spark):
                self.published.append(self.publish(op, staging, key))
        if made:
            self.made[name] = made

    def load_uri(self, uri: str, header: bool = True, separator: str = ",") -> DataFrame:
        connection = self.catalog.get(split_uri(uri)[0])
        if isinstance(connection, SftpConnection):
            raise FlowError("La lectura SFTP no está soportada; descargue primero a una carpeta local", "SFTP_READ_UNSUPPORTED")
        place = place_of(self.catalog, uri)
        return read_csv(self.spark, place if isinstance(place, str) else f"file://{place}", header, separator)

    @staticmethod
    def check_columns(df: DataFrame, names: list[str]) -> None:
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise FlowError(f"Columnas inexistentes: {missing}; disponibles {df.columns}", "COLUMN_MISSING")

    def ranked(self, df: DataFrame, node: Node, made: list[str]) -> tuple[DataFrame, Node]:
        """df with a column for each rank in the expression that many tasks have to make, and the expression over these columns."""
        if node.kind == WINDOW:
            r = ranking(node)
            if r.partition and self.hot_rows is None:
                return df, node
            made.append(f"_flow_rank{len(made)}")
            return with_rank(df, [lower(n) for n in r.partition], [lower(n) for n in r.order], r.down, r.mode, made[-1], self.hot_rows), Node(COLUMN, made[-1])
        children = []
        for child in node.children:
            df, child = self.ranked(df, child, made)
            children.append(child)
        return df, Node(node.kind, node.value, tuple(children))

    def selected(self, df: DataFrame, items: tuple[Selected, ...]) -> DataFrame:
        out, names, made = [], df.columns, []
        if not any(s.expression.kind == STAR for s in items):  # ranks may write their rows: only what is used
            used = {c for s in items for c in s.expression.columns()}
            df = df.select(*[column(c) for c in names if c in used]) if used and used <= set(names) else df
        for s in items:
            if s.expression.kind == STAR:
                out += [column(c) for c in names]
            else:
                self.check_columns(df, s.expression.columns())
                df, expression = self.ranked(df, s.expression, made)
                out.append(lower(expression).alias(s.name))
        return df.select(*out)

    def project(self, df: DataFrame, op: Project) -> DataFrame:
        if op.selecciones:
            out = self.selected(df, op.selecciones)
        else:
            names = list(op.campos) if op.campos != ("*",) else df.columns
            self.check_columns(df, names)
            renamed = dict(op.aliases)
            out = df.select(*[column(c).alias(renamed.get(c, c)) for c in names])
        return out.distinct() if op.distinct else out

    def filter(self, df: DataFrame, op: Filter) -> DataFrame:
        if op.expresion is not None:
            self.check_columns(df, op.expresion.columns())
            return df.filter(predicate(op.expresion))
        if len(op.condicion) > MAX_CONDITION or any(x in op.condicion for x in (";", "--", "/*", "*/")):
            raise FlowError("Condición no permitida", "CONDITION_NOT_ALLOWED")
        return df.filter(F.expr(op.condicion))

    def aggregate(self, df: DataFrame, op: Aggregate) -> DataFrame:
        """All keys in their order (under their aliases), then the metrics."""
        self.check_columns(df, list(op.grupo_por))
        names = {s.expression.value: s.name for s in op.selecciones if s.expression.kind == COLUMN}
        keys = [column(k) for k in op.grupo_por]
        metrics = [metric_text(t) for t in op.funciones]
        for s in op.selecciones:
            if s.expression.kind != COLUMN:
                self.check_columns(df, s.expression.columns())
                metrics.append(lower(s.expression).alias(s.name))
        if not metrics:
            return df.select(*[k.alias(names.get(n, n)) for k, n in zip(keys, op.grupo_por, strict=True)]).distinct()
        return df.groupBy(*[k.alias(names.get(n, n)) for k, n in zip(keys, op.grupo_por, strict=True)]).agg(*metrics)

    def publish(self, op: Publish, staging: Staging, key: str) -> dict:
        df = self.table(op.tabla_origen)
        if self.target:
            name = table_name(op.destino)
            self.target.write(df, name, self.secrets)
            return {"archivo": name, "estado": "PUBLICADO", "destino": "jdbc"}
        if op.formato not in ("txt", "csv"):
            raise FlowError(f"Formato no soportado: {op.formato}", "FORMAT_UNSUPPORTED")
        name, path = split_uri(op.destino)
        connection = self.catalog.get(name)
        stage = hashlib.sha256(f"{key}{op.destino}".encode()).hexdigest()[:24]
        if isinstance(connection, SftpConnection):
            return publish_sftp(df, connection, relative(path), self.secrets, staging, stage).as_dict()
        self.catalog.get(name, LocalConnection)
        place = place_of(self.catalog, op.destino, writing=True)
        return (publish_store(df, place) if isinstance(place, str) else publish_local(df, place, staging, stage)).as_dict()
