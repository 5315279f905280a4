"""Dataflow scripts: compile first, then connect, run and publish."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import SparkSession

from .errors import FlowError, ScriptError
from .plans.compiler import compile_script
from .plans.executor import Executor
from .plans.lexer import MAX_BYTES
from .plans.ops import Plan
from .sources.catalog import Catalog, Secrets
from .sources.jdbc import TargetDatabase

#: Shorter secrets may stand in a script by chance.
LEAST_SECRET = 8
#: Session settings that scripts rely on.
SETTINGS = {"spark.sql.caseSensitive": "true", "spark.sql.ansi.enabled": "true", "spark.sql.session.timeZone": "UTC"}


def read_script(path: str | None, text: str | None) -> str:
    if path and text:
        raise ScriptError([FlowError("Use un script o su contenido, no ambos", "DFS_SCRIPT_SOURCE_CONFLICT")])
    if not path and text is None:
        raise ScriptError([FlowError("Falta el script", "DFS_SCRIPT_SOURCE_MISSING")])
    if path:
        file = Path(path)
        if not file.is_file():
            raise ScriptError([FlowError("No existe el script", "DFS_FILE_NOT_FOUND")])
        if file.stat().st_size > MAX_BYTES:
            raise ScriptError([FlowError("El script es demasiado grande", "DFS_FILE_TOO_LARGE")])
        try:
            text = file.read_bytes().decode("utf-8")
        except UnicodeDecodeError as e:
            raise ScriptError([FlowError("El script no es UTF-8", "DFS_ENCODING_INVALID")]) from e
        except OSError as e:
            raise ScriptError([FlowError("No se pudo leer el script", "DFS_READ_ERROR")]) from e
    if not text.strip():
        raise ScriptError([FlowError("El script está vacío", "DFS_SCRIPT_EMPTY")])
    if len(text.encode()) > MAX_BYTES:
        raise ScriptError([FlowError("El script es demasiado grande", "DFS_FILE_TOO_LARGE")])
    return text


def compiled(text: str) -> tuple[Plan, dict]:
    """The plan and its result document; Spark, secrets and network are not used."""
    plan = compile_script(text)
    doc = {"estado": "COMPILADO", "hash": plan.hash, "operaciones": [op.tipo for op in plan.operaciones], "tabla_resultado": plan.tabla_resultado}
    return plan, doc


def session_for(spark: SparkSession) -> SparkSession:
    """A session of its own with the scripts' settings, so that the caller's stay as they are."""
    own = spark.newSession()
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    return own


def run_script(spark: SparkSession, text: str, catalog: Catalog, secrets: Secrets, target: TargetDatabase | None = None, run_id: str = "", origin: str = "contenido", hot_rows: int | None = None, skew_share: float | None = None) -> dict:
    plan, doc = compiled(text)
    if secrets.exposed({"plan": plan.to_json(), **doc}, LEAST_SECRET):
        raise FlowError("El script contiene un secreto", "SECRET_EXPOSED")
    executor = Executor(session_for(spark), catalog, secrets, target, hot_rows=hot_rows, skew_share=skew_share)
    tables = executor.run(plan)
    executor.release()
    return {
        "estado": "COMPLETADO", "ejecucion_id": run_id, "hash": plan.hash, "operaciones": len(plan.operaciones), "operaciones_ejecutadas": executor.done,
        "tablas_disponibles": sorted(tables), "publicaciones": executor.published, "origen_script": origin,
        "hash_script": hashlib.sha256(text.encode()).hexdigest(),
    }


def failure(error: Exception, secrets: Secrets | None = None) -> dict:
    """The error document, without secrets."""
    errors = error.errors if isinstance(error, ScriptError) else [error if isinstance(error, FlowError) else FlowError(f"{type(error).__name__}: {error}", "DFS_EXECUTION_ERROR")]
    hide = secrets.redact if secrets else str
    return {"estado": "ERROR", "errores": [e.as_dict() | {"mensaje": hide(e.message)} for e in errors]}
