"""The dataflow plan: frozen operations, canonical JSON, hash, explanation."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields

from ..errors import FlowError
from ..functions.exprs import Node, show


@dataclass(frozen=True)
class Selected:
    """An expression with the name that it gets."""

    expression: Node
    alias: str | None = None

    @property
    def name(self) -> str:
        if self.alias:
            return self.alias
        if self.expression.kind == "columna":
            return self.expression.value
        raise FlowError("Una expresión calculada necesita alias", "DFS_ALIAS_REQUIRED")


@dataclass(frozen=True)
class ReadJdbc:
    nombre_tabla: str
    conexion_nombre: str
    esquema: str | None
    tabla: str
    campos: tuple[str, ...]
    filtros_where: str | None = None
    tipo: str = "leer_jdbc"


@dataclass(frozen=True)
class Project:
    tabla_origen: str
    campos: tuple[str, ...]
    alias: str | None = None
    aliases: tuple[tuple[str, str], ...] = ()
    selecciones: tuple[Selected, ...] = ()
    distinct: bool = False
    tipo: str = "proyectar"


@dataclass(frozen=True)
class Filter:
    tabla_origen: str
    condicion: str
    expresion: Node | None = None
    tipo: str = "filtrar"


@dataclass(frozen=True)
class Concat:
    tabla_objetivo: str
    tabla_origen: str
    noconcatenate: bool = False
    tipo: str = "concatenar"


@dataclass(frozen=True)
class Join:
    tabla_izquierda: str
    tabla_derecha: str
    condicion_on: str = "NATURAL"
    tipo_join: str = "LEFT"
    tipo: str = "unir"


@dataclass(frozen=True)
class Aggregate:
    tabla_origen: str
    grupo_por: tuple[str, ...]
    funciones: tuple[str, ...] = ()
    selecciones: tuple[Selected, ...] = ()
    tabla_resultado: str | None = None
    tipo: str = "agregar"


@dataclass(frozen=True)
class Drop:
    nombre: str
    tipo: str = "eliminar_tabla"


@dataclass(frozen=True)
class Publish:
    tabla_origen: str
    destino: str
    formato: str = "txt"
    tipo: str = "publicar"


@dataclass(frozen=True)
class LoadCsv:
    nombre_tabla: str
    ruta: str
    tiene_header: bool = True
    delimitador: str = ","
    tipo: str = "cargar_csv"


@dataclass(frozen=True)
class LoadLocal:
    ruta: str
    nombre_tabla: str
    tipo: str = "cargar_local"


OPS = {cls.__dataclass_fields__["tipo"].default: cls for cls in (ReadJdbc, Project, Filter, Concat, Join, Aggregate, Drop, Publish, LoadCsv, LoadLocal)}
Op = ReadJdbc | Project | Filter | Concat | Join | Aggregate | Drop | Publish | LoadCsv | LoadLocal


def reads(op: Op) -> list[str]:
    """The tables that an operation uses."""
    names = [getattr(op, k, None) for k in ("tabla_origen", "tabla_objetivo", "tabla_izquierda", "tabla_derecha")]
    return [n for n in names if n] + ([op.ruta] if isinstance(op, LoadLocal) else [])


def writes(op: Op) -> str | None:
    """The table that an operation makes or replaces."""
    if isinstance(op, Project):
        return op.alias or op.tabla_origen
    if isinstance(op, Aggregate):
        return op.tabla_resultado or op.tabla_origen
    for key in ("nombre_tabla", "tabla_objetivo", "tabla_izquierda"):
        if hasattr(op, key):
            return getattr(op, key)
    return op.tabla_origen if isinstance(op, Filter) else None


@dataclass(frozen=True)
class Plan:
    operaciones: tuple[Op, ...] = ()
    tabla_resultado: str | None = None
    metadata: dict = field(default_factory=dict)

    def as_dict(self) -> dict:
        def plain(value):
            if isinstance(value, Node):
                return value.as_dict()
            if isinstance(value, Selected):
                return {"expresion": value.expression.as_dict(), "alias": value.alias}
            return [plain(x) for x in value] if isinstance(value, tuple) else value

        ops = [{f.name: plain(getattr(op, f.name)) for f in fields(op)} for op in self.operaciones]
        return {"operaciones": ops, "tabla_resultado": self.tabla_resultado, "metadata": self.metadata}

    def to_json(self) -> str:
        return json.dumps(self.as_dict(), sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.to_json().encode()).hexdigest()

    @property
    def ids(self) -> list[str]:
        """A stable id for each operation."""
        return [hashlib.sha256(f"{writes(op) or (reads(op) or [getattr(op, 'nombre', '')])[0]}_{op.tipo}_{i}".encode()).hexdigest()[:16] for i, op in enumerate(self.operaciones)]

    @classmethod
    def of(cls, doc: dict) -> Plan:
        """The plan of as_dict(); unknown operations and fields are errors."""
        ops = []
        for one in doc["operaciones"]:
            kind = OPS.get(one.get("tipo"))
            extra = set(one) - {f.name for f in fields(kind)} if kind else None
            if kind is None or extra:
                raise FlowError(f"Operación inválida: {one.get('tipo')} {sorted(extra or ())}", "PLAN_INVALID")
            values = {k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in one.items()}
            if "selecciones" in values:
                values["selecciones"] = tuple(Selected(Node.of(x["expresion"]), x["alias"]) for x in one["selecciones"])
            if values.get("expresion") is not None:
                values["expresion"] = Node.of(one["expresion"])
            ops.append(kind(**values))
        return cls(tuple(ops), doc.get("tabla_resultado"), doc.get("metadata") or {})

    @classmethod
    def from_json(cls, text: str, expected_hash: str | None = None) -> Plan:
        plan = cls.of(json.loads(text))
        if expected_hash and plan.hash != expected_hash:
            raise FlowError("El plan no tiene el hash esperado", "PLAN_INTEGRITY")
        return plan

    def explain(self) -> str:
        """A line for each operation."""
        lines = []
        for i, (op, key) in enumerate(zip(self.operaciones, self.ids, strict=True), 1):
            rest = {k: v for k, v in asdict(op).items() if k not in ("tipo", "selecciones", "expresion") and v not in (None, (), "")}
            if getattr(op, "selecciones", ()):
                rest["selecciones"] = [show(s.expression) + (f" AS {s.alias}" if s.alias else "") for s in op.selecciones]
            if getattr(op, "expresion", None):
                rest["expresion"] = show(op.expresion)
            lines.append(f"{i:3d} [{key}] {op.tipo} " + " ".join(f"{k}={v}" for k, v in rest.items()))
        return "\n".join([*lines, f"resultado: {self.tabla_resultado}", f"hash: {self.hash}"])
