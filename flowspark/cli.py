"""Command line: recipes (--receta) and dataflow scripts (--dataflow-script)."""

from __future__ import annotations

import argparse
import json
import os
import sys
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

from .dataflow import compiled, failure, read_script, run_script
from .errors import FlowError
from .recipe import load_recipe, run_recipe
from .sources.catalog import SECRET_NAME, Secrets, load_catalog
from .sources.jdbc import TargetDatabase, packages

SCRIPT_FLAGS = ("--dataflow-script", "-dataflowscript", "--dataflow-script-contenido")


def save_json(path: str | None, doc: dict | str) -> None:
    """Atomic; without a path nothing is written."""
    if not path:
        return
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    text = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False, indent=2, default=str)
    handle, name = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}-")
    with os.fdopen(handle, "w", encoding="utf-8") as file:
        file.write(text)
    os.replace(name, target)


def secret_pairs(items: list[str]) -> dict[str, str]:
    out: dict[str, str] = {}
    for item in items:
        name, sign, value = item.partition("=")
        if not sign or not SECRET_NAME.fullmatch(name) or name in out or "\n" in value:
            raise FlowError(f"Secreto inválido: {name!r}", "SECRET_INVALID")
        out[name] = value
    return out


def parser(script: bool) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="flowspark", allow_abbrev=False)
    out.add_argument("--ejecucion-id", required=True)
    out.add_argument("--resultado")
    if script:
        source = out.add_mutually_exclusive_group(required=True)
        source.add_argument("--dataflow-script", "-dataflowscript", dest="script")
        source.add_argument("--dataflow-script-contenido", dest="text")
        catalog = out.add_mutually_exclusive_group(required=True)
        catalog.add_argument("--conexiones", dest="catalog")
        catalog.add_argument("--conexiones-contenido", dest="catalog_text")
        out.add_argument("--secreto", action="append", default=[])
        out.add_argument("--base-destino", dest="target")
        out.add_argument("--solo-compilar", action="store_true", dest="compile_only")
        out.add_argument("--plan-salida", dest="plan")
        out.add_argument("--filas-por-particion", type=int, dest="hot_rows")
        out.add_argument("--claves-pesadas", type=float, dest="skew_share")
        out.add_argument("--solo-paquetes", action="store_true", dest="packages_only")
    else:
        for name in ("--receta", "--entrada", "--salida"):
            out.add_argument(name, required=True)
        out.add_argument("--esquema")
    return out


def report(path: str | None, doc: dict) -> int:
    save_json(path, doc)
    failed = doc["estado"] == "ERROR"
    print("RESULTADO_MOTOR=" + json.dumps(doc, ensure_ascii=False, default=str), file=sys.stderr if failed else sys.stdout, flush=True)
    return int(failed)


def session(name: str, shuffle: int | None = None, log_level: str = "WARN") -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true")
    if shuffle:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def recipe_main(args: argparse.Namespace) -> int:
    spark = None
    try:
        recipe = load_recipe(args.receta)
        spark = session(recipe.name, recipe.shuffle_partitions, recipe.log_level)
        doc = run_recipe(spark, recipe, args.entrada, args.salida, args.esquema, args.ejecucion_id)
    except Exception as e:
        doc = {"estado": "ERROR", "ejecucion_id": args.ejecucion_id, "entrada": args.entrada, "salida": args.salida, "tipo_error": type(e).__name__, "mensaje": str(e)}
    finally:
        if spark:
            spark.stop()
    return report(args.resultado, doc)


def script_main(args: argparse.Namespace) -> int:
    spark, secrets = None, Secrets()
    try:
        text = read_script(args.script, args.text)
        plan, doc = compiled(text)
        if args.compile_only:
            save_json(args.plan, plan.to_json())
        else:
            secrets = Secrets.from_environment(secret_pairs(args.secreto))
            catalog = load_catalog(args.catalog_text or args.catalog, inline=bool(args.catalog_text))
            target = TargetDatabase.of(json.loads(args.target if args.target.lstrip().startswith("{") else Path(args.target).read_text("utf-8"))) if args.target else None
            if args.packages_only:
                print(",".join(packages(catalog, target)))
                return 0
            spark = session("flowspark dataflow")
            doc = run_script(spark, text, catalog, secrets, target, args.ejecucion_id, "archivo" if args.script else "contenido", args.hot_rows, args.skew_share)
    except Exception as e:
        doc = failure(e, secrets) | {"ejecucion_id": args.ejecucion_id}
    finally:
        if spark:
            spark.stop()
    return report(args.resultado, doc)


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    script = any(a.split("=")[0] in SCRIPT_FLAGS for a in argv)
    args = parser(script).parse_args(argv)
    return script_main(args) if script else recipe_main(args)


if __name__ == "__main__":
    sys.exit(main())
