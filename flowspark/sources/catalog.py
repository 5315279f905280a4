"""Connections with allow-lists, lib:// addresses, secrets."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field
from pathlib import Path

from ..errors import FlowError

MAX_BYTES = 10 * 1024 * 1024
SECRETS_VARIABLE = "MOTOR_SECRETOS_JSON"
SECRET_NAME = re.compile(r"[A-Za-z_]\w*")
#: Names that Windows keeps for devices.
DEVICES = {"con", "prn", "aux", "nul", *(f"{d}{i}" for d in ("com", "lpt") for i in range(1, 10))}
FILE_ENDINGS = (".csv", ".txt")
#: What a text that becomes part of an SQL statement may not hold.
UNSAFE_WORDS = ("UNION", "SELECT", "INSERT", "UPDATE", "DELETE", "DROP", "EXEC", "EXECUTE")
UNSAFE_SIGNS = (";", "--", "/*")
UNSAFE = re.compile("|".join([rf"\b(?:{'|'.join(UNSAFE_WORDS)})\b", r"\b(?:OR|AND)\b.*=", *map(re.escape, UNSAFE_SIGNS)]), re.IGNORECASE | re.DOTALL)


def safe_for_sql(text: str) -> str:
    """The text, if nothing in it could change a statement that it becomes part of."""
    if UNSAFE.search(text):
        raise FlowError(f"Texto no seguro para SQL: {text!r}", "SQL_UNSAFE")
    return text


class Secrets:
    """Secrets by name: those given win over the environment."""

    def __init__(self, given: dict[str, str] | None = None):
        for name, value in (given or {}).items():
            if not SECRET_NAME.fullmatch(name) or "\n" in value:
                raise FlowError(f"Nombre o valor de secreto inválido: {name}", "SECRET_INVALID")
        self.given = dict(given or {})

    @classmethod
    def from_environment(cls, explicit: dict[str, str] | None = None) -> Secrets:
        """Secrets of the JSON variable; explicit ones win."""
        text = os.environ.get(SECRETS_VARIABLE, "").strip()
        try:
            held = json.loads(text) if text else {}
        except ValueError as e:
            raise FlowError(f"{SECRETS_VARIABLE} no es JSON", "SECRET_INVALID") from e
        if not isinstance(held, dict) or not all(isinstance(v, str) for v in held.values()):
            raise FlowError(f"{SECRETS_VARIABLE} debe ser un objeto de cadenas", "SECRET_INVALID")
        return cls(held | (explicit or {}))

    def get(self, name: str) -> str | None:
        return self.given.get(name, os.environ.get(name))

    def __contains__(self, name: str) -> bool:
        return self.get(name) is not None

    def require(self, name: str) -> str:
        value = self.get(name)
        if not value:
            raise FlowError(f"Falta el secreto {name}", "SECRET_MISSING")
        return value

    def redact(self, text: str) -> str:
        for value in sorted(filter(None, self.given.values()), key=len, reverse=True):
            text = text.replace(value, "***")
        return text

    def exposed(self, doc: dict, least: int = 1) -> bool:
        """Whether a document shows one of the secrets of at least so many characters."""
        text = json.dumps(doc, ensure_ascii=False)
        return any(len(v) >= least and v in text for v in self.given.values())


@dataclass(frozen=True)
class JdbcConnection:
    name: str
    url: str
    driver: str | None
    secret: str | None
    tables: dict[str, tuple[str, ...]]  # "schema.table" or "table": columns
    options: dict = field(default_factory=dict)
    splits: dict[str, dict] = field(default_factory=dict)  # table: column, bounds and number of ranges


@dataclass(frozen=True)
class LocalConnection:
    name: str
    base: str
    files: tuple[str, ...]


@dataclass(frozen=True)
class SftpConnection:
    name: str
    host: str
    port: int
    user: str
    base: str
    secret: str | None = None
    key_file: str | None = None
    key_secret: str | None = None
    known_hosts: str | None = None


@dataclass(frozen=True)
class Catalog:
    connections: dict

    def get(self, name: str, kind: type | None = None):
        found = self.connections.get(name)
        if found is None or kind is not None and not isinstance(found, kind):
            raise FlowError(f"Conexión no permitida: {name}", "CONNECTION_NOT_ALLOWED")
        return found


def relative(path: str) -> str:
    """A safe relative path of a .csv or .txt file."""
    parts = path.split("/")
    if not path or path.startswith("/") or re.search(r"[\\\x00%+]", path):
        raise FlowError(f"Ruta no permitida: {path!r}", "PATH_NOT_ALLOWED")
    for part in parts:
        if part in ("", ".", "..") or part.endswith((".", " ")) or part.split(".")[0].lower() in DEVICES:
            raise FlowError(f"Ruta no permitida: {path!r}", "PATH_NOT_ALLOWED")
    if not path.lower().endswith(FILE_ENDINGS):
        raise FlowError(f"Solo se admiten archivos {FILE_ENDINGS}: {path!r}", "PATH_NOT_ALLOWED")
    return path


def split_uri(uri: str) -> tuple[str, str]:
    """lib://connection/path to its two parts."""
    m = re.fullmatch(r"lib://([^/]+)/(.+)", uri)
    if not m:
        raise FlowError(f"URI inválida: {uri!r}", "URI_INVALID")
    return m[1], m[2]


def local_path(catalog: Catalog, uri: str, writing: bool = False) -> Path:
    """The file of a lib:// address, inside the connection's folder even through links, and on its list."""
    name, path = split_uri(uri)
    connection = catalog.get(name, LocalConnection)
    base = Path(connection.base).resolve()
    if writing and path.startswith("/"):  # an absolute target below the folder
        path = os.path.relpath(path, connection.base) if Path(path).is_relative_to(connection.base) else path
    path = relative(path)
    if not writing and connection.files and path not in connection.files:
        raise FlowError(f"Archivo fuera de la lista: {path}", "FILE_NOT_ALLOWED")
    full = (base / path).resolve()
    if not full.is_relative_to(base):
        raise FlowError(f"Ruta fuera de la carpeta: {path}", "PATH_NOT_ALLOWED")
    return full


def place_of(catalog: Catalog, uri: str, writing: bool = False) -> Path | str:
    """The file of a lib:// address: a local path or, where the connection's folder is an address of a store (with ://), an address below it."""
    name, path = split_uri(uri)
    connection = catalog.get(name, LocalConnection)
    if "://" not in connection.base:
        return local_path(catalog, uri, writing)
    path = relative(path)
    if not writing and connection.files and path not in connection.files:
        raise FlowError(f"Archivo fuera de la lista: {path}", "FILE_NOT_ALLOWED")
    return f"{connection.base.rstrip('/')}/{path}"


def expand(text: str) -> str:
    """${NAME} and ${NAME:default} from the environment."""

    def value(m: re.Match) -> str:
        found = os.environ.get(m[1], m[3])
        if found is None:
            raise FlowError(f"Falta la variable {m[1]}", "VARIABLE_MISSING")
        return found

    return re.sub(r"\$\{(\w+)(:([^}]*))?\}", value, text)


def load_catalog(source: str, inline: bool = False) -> Catalog:
    """A catalog from a file or a JSON text of at most 10 MiB."""
    if not inline:
        path = Path(source)
        if not path.is_file():
            raise FlowError("No existe el catálogo", "CATALOG_NOT_FOUND")
        if path.stat().st_size > MAX_BYTES:
            raise FlowError("El catálogo es demasiado grande", "CATALOG_TOO_LARGE")
        source = path.read_text("utf-8")
    if len(source.encode()) > MAX_BYTES:
        raise FlowError("El catálogo es demasiado grande", "CATALOG_TOO_LARGE")
    try:
        doc = json.loads(source)
    except ValueError as e:
        raise FlowError("El catálogo no es JSON", "CATALOG_INVALID") from e
    if not isinstance(doc, dict):
        raise FlowError("El catálogo debe ser un objeto", "CATALOG_INVALID")
    held = [c for section in ("jdbc", "locales", "sftp", "conexiones") for c in doc.get(section) or []]
    out: dict = {}
    for one in held:
        name, kind = str(one.get("nombre", "")), str(one.get("tipo", "")).lower()
        if not name or name in out:
            raise FlowError(f"Conexión sin nombre o repetida: {name!r}", "CATALOG_INVALID")
        allowed = [(a.get("esquema") or "", a.get("tabla") or "", tuple(a.get("campos") or ())) for a in one.get("allowlist") or []]
        secret = one.get("secreto_nombre")
        try:
            if kind == "jdbc":
                tables = {f"{schema}.{table}" if schema else table: columns for schema, table, columns in allowed}
                splits = {a["tabla"]: a["particion"] for a in one.get("allowlist") or [] if a.get("tabla") and a.get("particion")}
                out[name] = JdbcConnection(name, one["url"], one.get("driver"), secret, tables, one.get("propiedades") or {}, splits)
            elif kind == "local":
                out[name] = LocalConnection(name, one["ruta_base"], tuple(table for _, table, _ in allowed))
            elif kind == "sftp":
                out[name] = SftpConnection(name, one["host"], int(one.get("puerto", 22)), one.get("usuario") or "", one.get("ruta_base", "/"), secret, one.get("clave_privada"), one.get("secreto_clave_privada_nombre"), one.get("known_hosts"))
            else:
                raise FlowError(f"Tipo de conexión desconocido: {kind!r}", "CATALOG_INVALID")
        except KeyError as e:
            raise FlowError(f"Conexión {name}: falta {e}", "CATALOG_INVALID") from e
    return Catalog(out)
