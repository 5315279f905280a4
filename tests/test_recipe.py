import json

import pytest

from flowspark.errors import RecipeError
from flowspark.operators.incremental import first_of_key
from flowspark.operators.steps import STEPS, apply_steps
from flowspark.recipe import load_recipe, run_recipe

OUTPUT = {"formato": "parquet"}


def test_all_steps_are_registered():
    assert len(STEPS) == 11


def test_step_chain(spark):
    """Each step works on what the one before gave, also where it uses a column that an earlier step made."""
    rows = [("k7", "  Tuerca", 4, None), ("k7", "Tuerca  ", 4, 1.5), ("k9", "PERNO", 0, 2.0), (None, "clavo", 3, 0.25)]
    df = spark.createDataFrame(rows, "clave string, pieza string, cantidad int, peso double")
    steps = [
        {"tipo": "normalizar_texto", "columnas": ["pieza"], "operaciones": ["trim", "lower"]},
        {"tipo": "rellenar_nulos", "valores": {"peso": 1.5, "clave": "sin"}},
        {"tipo": "filtrar", "expresion": "cantidad > 0"},
        {"tipo": "crear_columna", "nombre": "carga", "expresion": "cantidad * peso"},
        {"tipo": "eliminar_duplicados", "columnas": []},
        {"tipo": "renombrar_columna", "origen": "pieza", "destino": "nombre"},
        {"tipo": "eliminar_columnas", "columnas": ["peso", "cantidad"]},
    ]
    out = apply_steps(df, steps)
    assert out.columns == ["clave", "nombre", "carga"]
    assert sorted(map(tuple, out.collect())) == [("k7", "tuerca", 6.0), ("sin", "clavo", 0.75)]


def test_step_errors(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    for bad in (
        {"tipo": "seleccionar_columnas", "columnas": ["x"]},
        {"tipo": "eliminar_columnas", "columnas": ["x"]},
        {"tipo": "renombrar_columna", "origen": "a", "destino": "b"},
        {"tipo": "normalizar_texto", "columnas": ["a"], "operaciones": ["reverse"]},
        {"tipo": "agrupar", "columnas": ["a"], "metricas": [{"operacion": "median", "columna": "b", "alias": "m"}]},
        {"tipo": "convertir_tipo", "columna": "a", "destino": "mapa"},
    ):
        with pytest.raises(RecipeError):
            apply_steps(df, [bad])


def test_duplicates_without_columns_use_the_whole_row(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], ["a", "b"])
    assert apply_steps(df, [{"tipo": "eliminar_duplicados", "columnas": []}]).count() == 2


def test_recipe_document():
    recipe = load_recipe(json.dumps({"salida": OUTPUT, "pasos": [{"tipo": "filtrar", "expresion": "a > 1"}]}))
    assert recipe.name == "receta" and recipe.input.format == "csv" and recipe.output.mode == "error"
    for bad in ({}, {"salida": OUTPUT, "pasos": [{"tipo": "volar"}]}, {"salida": {"formato": "csv"}}, {"salida": OUTPUT, "incremental": {"activo": True}}, {"salida": OUTPUT, "entrada": {"modo_esquema": "x"}}):
        with pytest.raises(RecipeError):
            load_recipe(json.dumps(bad))


def test_strict_run(spark, tmp_path):
    source = tmp_path / "bodega.csv"
    source.write_text("sku;estante;peso\nA-1; norte ;0.125\nB-2;sur;\nC-3; norte;7.5\n")
    doc = {
        "entrada": {"opciones": {"header": True, "sep": ";"}},
        "pasos": [{"tipo": "normalizar_texto", "columnas": ["estante"], "operaciones": ["trim"]}, {"tipo": "filtrar", "expresion": "peso is not null"}],
        "salida": OUTPUT | {"numero_particiones": 1, "particionar_por": ["estante"]},
        "auditoria": {"contar_registros": True},
    }
    events, out = [], tmp_path / "out"
    result = run_recipe(spark, load_recipe(json.dumps(doc)), str(source), str(out), "sku:texto|estante:texto|peso:decimal(6,3)", "e1", events.append)
    assert (result["estado"], result["total_registros"], result["cantidad_archivos_parquet"]) == ("COMPLETADO", 2, 1)
    assert [p.name for p in out.iterdir() if p.is_dir()] == ["estante=norte"]
    assert sorted((r["sku"], str(r["peso"])) for r in spark.read.parquet(str(out)).collect()) == [("A-1", "0.125"), ("C-3", "7.500")]
    assert [e.split("=")[0] for e in events][:2] == ["EJECUCION_INICIO", "MODO_ESQUEMA_ENTRADA"]


def test_inferred_run(spark, tmp_path):
    source = tmp_path / "x.csv"
    source.write_text("Método de Pago,2026 Total\nA,1\nB,2\n")
    doc = {"entrada": {"modo_esquema": "inferir", "tipos_forzados": {"col_2026_total": "long"}}, "salida": OUTPUT}
    result = run_recipe(spark, load_recipe(json.dumps(doc)), str(source), str(tmp_path / "out"), None, "e", lambda _: None)
    assert result["esquema_salida_simple"] == "struct<metodo_de_pago:string,col_2026_total:bigint>"


def jobs_of(spark, name, work):
    """Jobs that some work runs."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


@pytest.mark.parametrize("forced", [{}, {"total": "long"}])
def test_a_counted_load_is_one_job(spark, tmp_path, forced):
    spark.range(50).selectExpr("cast(id as string) AS total", "id % 3 AS g").write.parquet(f"{tmp_path}/in")
    doc = {"entrada": {"formato": "parquet", "modo_esquema": "inferir", "tipos_forzados": forced}, "pasos": [{"tipo": "filtrar", "expresion": "g > 0"}], "salida": OUTPUT, "auditoria": {"contar_registros": True}}
    plain = doc | {"auditoria": {}, "entrada": {"formato": "parquet", "modo_esquema": "inferir"}}
    run = lambda d, to: lambda: run_recipe(spark, load_recipe(json.dumps(d)), f"{tmp_path}/in", f"{tmp_path}/{to}", None, "e", lambda _: None)
    _, least = jobs_of(spark, f"plain{len(forced)}", run(plain, "a"))
    told, jobs = jobs_of(spark, f"counted{len(forced)}", run(doc, "b"))
    assert told["total_registros"] == 33 and jobs == least
    assert spark.read.parquet(f"{tmp_path}/b").dtypes[0][1] == ("bigint" if forced else "string")


@pytest.mark.parametrize("extra", [{}, {"incremental": {"activo": True, "claves": ["total"]}, "salida": OUTPUT | {"modo": "append"}}])
@pytest.mark.parametrize("step", ["g > 0", "false", "total < '3'"])
def test_values_that_cannot_be_forced_leave_the_target_alone(spark, tmp_path, extra, step):
    """Rows that a later step leaves out are held to the forced types too."""
    spark.createDataFrame([("1", 1), ("x", 2), (" ", 0)], "total string, g int").write.parquet(f"{tmp_path}/in")
    doc = {"entrada": {"formato": "parquet", "modo_esquema": "inferir", "tipos_forzados": {"total": "long"}}, "pasos": [{"tipo": "filtrar", "expresion": step}], "salida": OUTPUT} | extra
    with pytest.raises(RecipeError) as e:
        run_recipe(spark, load_recipe(json.dumps(doc)), f"{tmp_path}/in", f"{tmp_path}/out", None, "e", lambda _: None)
    assert e.value.code == "FORCED_TYPE_INVALID" and not [p for p in (tmp_path / "out").rglob("*.parquet")]


def test_incremental(spark, tmp_path):
    def run(rows: str, name: str, schema: str = "lote:long|sello:string"):
        source = tmp_path / name
        source.write_text(rows)
        doc = {"entrada": {"opciones": {"header": True}}, "salida": OUTPUT | {"modo": "append"}, "incremental": {"activo": True, "claves": ["lote"]}}
        return run_recipe(spark, load_recipe(json.dumps(doc)), str(source), str(tmp_path / "out"), schema, "e", lambda _: None)

    wide = "lote:long|sello:string|turno:string"
    first = run("lote,sello\n40,q\n40,p\n41,r\n40,p\n42,\n", "1.csv")
    assert (first["total_registros"], first["total_registros_entrada"], first["total_registros_nuevos"], first["total_registros_duplicados"]) == (3, 5, 3, 2)
    second = run("lote,sello,turno\n41,zz,x\n43,t,y\n", "2.csv", wide)
    assert (second["total_registros_antes"], second["total_registros_nuevos"], second["total_registros"]) == (3, 1, 4)
    assert run("lote,sello,turno\n43,u,y\n", "3.csv", wide)["total_registros_nuevos"] == 0
    held = {r["lote"]: r["sello"] for r in spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "out")).collect()}
    assert held == {40: "p", 41: "r", 42: None, 43: "t"}  # of a key's rows the least stays, and a row that is there stays as it is
    with pytest.raises(RecipeError):
        run("lote,sello,turno\n,b,x\n", "4.csv", wide)
    with pytest.raises(RecipeError):
        run("lote,sello\n9,b\n", "5.csv")


def test_first_row_of_a_key(spark):
    rows = [(1, None, [2], {"a": 1}), (1, "b", [1], {"a": 2}), (1, None, [1], {"a": 3}), (2, "z", None, None), (None, "y", [5], None)]
    df = spark.createDataFrame(rows, "k int, s string, l array<int>, m map<string,int>")
    got = first_of_key(df, ["k"])
    assert got.columns == df.columns
    assert sorted(((r["k"], r["s"], r["l"], r["m"]) for r in got.collect()), key=str) == sorted([(1, None, [1], {"a": 3}), (2, "z", None, None), (None, "y", [5], None)], key=str)
    assert first_of_key(df.select("k"), ["k"]).count() == 3


def test_overwrite_guard(spark, tmp_path):
    source = tmp_path / "x.csv"
    source.write_text("a\n1\n")
    doc = {"entrada": {"opciones": {"header": True}}, "salida": OUTPUT | {"modo": "overwrite", "raiz_local": str(tmp_path / "root")}}
    recipe = load_recipe(json.dumps(doc))
    with pytest.raises(RecipeError):
        run_recipe(spark, recipe, str(source), str(tmp_path / "elsewhere"), "a:int", "e", lambda _: None)
    for _ in range(2):
        assert run_recipe(spark, recipe, str(source), str(tmp_path / "root" / "x"), "a:int", "e", lambda _: None)["estado"] == "COMPLETADO"
