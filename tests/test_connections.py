import collections
import csv
import json
import random
import re

import pytest

from flowspark.cli import main
from flowspark.dataflow import run_script
from flowspark.errors import FlowError
from flowspark.plans.compiler import compile_script
from flowspark.plans.executor import Executor
from flowspark.sinks.publish import CsvWriter, Staging, publish_sftp, publish_store, single_csv
from flowspark.sources.catalog import JdbcConnection, Secrets, SftpConnection, load_catalog, local_path, place_of, relative, safe_for_sql
from flowspark.sources.jdbc import TargetDatabase, cells_of, even_predicates, measured_split, package_of, packages, scan_options, subquery, table_name
from flowspark.streaming.csv_sink import stream_to_csv, written_parts


def catalog_of(base, files=("in.csv",)):
    local = {"nombre": "datos", "tipo": "local", "ruta_base": str(base), "allowlist": [{"esquema": "", "tabla": f, "campos": []} for f in files]}
    remote = {"nombre": "remoto", "tipo": "sftp", "host": "h", "usuario": "u", "ruta_base": "/d"}
    database = {"nombre": "db", "tipo": "jdbc", "url": "jdbc:x", "driver": "d", "secreto_nombre": "S", "allowlist": [{"esquema": "e", "tabla": "t", "campos": ["a"]}], "propiedades": {"ssl": "false"}}
    return load_catalog(json.dumps({"version": 1, "jdbc": [database], "locales": [local], "sftp": [remote]}), inline=True)


@pytest.mark.parametrize("path", ["", "/etc/x.csv", "../x.csv", "a/../x.csv", "a\\x.csv", "a%2e.csv", "a+b.csv", "con.csv", "x.exe", "a./x.csv", "a//x.csv"])
def test_unsafe_paths(path):
    with pytest.raises(FlowError):
        relative(path)


def test_allow_list(tmp_path):
    catalog = catalog_of(tmp_path)
    assert local_path(catalog, "lib://datos/in.csv") == tmp_path / "in.csv"
    for bad in ("lib://datos/otro.csv", "lib://nadie/in.csv", "file:///x.csv"):
        with pytest.raises(FlowError):
            local_path(catalog, bad)
    (tmp_path / "sub").symlink_to("/tmp")
    with pytest.raises(FlowError):
        local_path(catalog, "lib://datos/sub/x.csv", writing=True)


def test_secrets(monkeypatch):
    monkeypatch.setenv("MOTOR_SECRETOS_JSON", json.dumps({"A": "uno", "B": "dos"}))
    secrets = Secrets.from_environment({"B": "tres"})
    assert (secrets.get("A"), secrets.get("B"), "C" in secrets) == ("uno", "tres", False)
    assert secrets.redact("x tres y") == "x *** y" and secrets.exposed({"k": "tres"}) and not secrets.exposed({"k": 1})
    with pytest.raises(FlowError):
        secrets.require("C")


def test_jdbc_options():
    connection = JdbcConnection("db", "jdbc:postgresql://${FLOW_HOST:localhost}/x", "org.postgresql.Driver", "CRED", {"ventas.t": ("a", "b")}, {"fetchsize": 10})
    options = scan_options(connection, "ventas", "t", ("a",), Secrets({"CRED": "u:p:q"}))
    assert options["dbtable"] == '(SELECT "a" FROM "ventas"."t") AS flow_source' and options["password"] == "p:q" and options["url"].endswith("localhost/x")
    for schema, name, columns in (("ventas", "t", ("c",)), ("otro", "x", ("a",))):
        with pytest.raises(FlowError):
            scan_options(connection, schema, name, columns, Secrets({"CRED": "u:p"}))
    with pytest.raises(FlowError):
        subquery(None, "t; drop", ["a"])
    with pytest.raises(FlowError):
        subquery(None, "t", [])
    assert package_of("org.postgresql.Driver").startswith("org.postgresql:")
    held = catalog_of("/tmp").get("db", JdbcConnection)
    assert held.tables == {"e.t": ("a",)} and held.secret == "S" and held.options == {"ssl": "false"}
    assert TargetDatabase.of({"host": "h", "base_datos": "b"}).url == "jdbc:postgresql://h:5432/b"
    target = TargetDatabase.of({"url": "jdbc:x", "driver": "d", "esquema": "s"})
    assert target.options("t", Secrets())["dbtable"] == '"s"."t"' and table_name("lib://c/Mi Salida-1.csv") == "mi_salida_1"


def test_jdbc_ranges():
    allowed = [{"esquema": "e", "tabla": "t", "campos": ["a", "b"], "particion": {"columna": "a", "minimo": 1, "maximo": "900", "particiones": 8}}]
    catalog = load_catalog(json.dumps({"jdbc": [{"nombre": "db", "tipo": "jdbc", "url": "jdbc:x", "driver": "org.postgresql.Driver", "allowlist": allowed}]}), inline=True)
    options = scan_options(catalog.get("db"), "e", "t", ("b",), Secrets())
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["a", "1", "900", "8"]
    for bad in ({"columna": "zz"}, {"maximo": "1; drop"}, {"particiones": 0}, {"minimo": None}):
        broken = JdbcConnection("db", "jdbc:x", None, None, {"e.t": ("a", "b")}, {}, {"t": allowed[0]["particion"] | bad})
        with pytest.raises(FlowError):
            scan_options(broken, "e", "t", ("b",), Secrets())


def test_packages_are_known_before_the_start(tmp_path, capsys):
    def catalog(*drivers):
        return json.dumps({"jdbc": [{"nombre": f"db{i}", "tipo": "jdbc", "url": "jdbc:x", "driver": d} for i, d in enumerate(drivers)]})

    held = load_catalog(catalog("org.mariadb.jdbc.Driver", "org.postgresql.Driver", "org.mariadb.jdbc.Driver"), inline=True)
    assert [p.split(":")[0] for p in packages(held)] == ["org.mariadb.jdbc", "org.postgresql"]
    own = TargetDatabase.of({"url": "jdbc:y", "driver": "com.example.Driver"})
    assert packages(held, own) == packages(held)
    assert len(packages(held, TargetDatabase.of({"url": "jdbc:y", "driver": "com.mysql.cj.jdbc.Driver"}))) == 3
    with pytest.raises(FlowError):
        packages(load_catalog(catalog("com.example.Driver"), inline=True))
    arguments = ["--dataflow-script-contenido", "a: LOAD x FROM [lib://c/f.csv];", "--conexiones-contenido", catalog("org.postgresql.Driver"), "--ejecucion-id", "e"]
    assert main([*arguments, "--solo-paquetes", "--base-destino", json.dumps({"host": "h", "db": "b"})]) == 0
    assert capsys.readouterr().out.strip() == packages(held)[1]


@pytest.mark.parametrize("text", ["x; y", "1 -- z", "a /* b", "1 OR 1=1", "p and q = r", "union all", "Drop it", "exec p"])
def test_texts_that_are_unsafe_in_sql(text):
    with pytest.raises(FlowError):
        safe_for_sql(text)


def test_texts_that_are_safe_in_sql():
    for text in ("2024-01-01", "selection of androids", "", "oro = plata", "dropped"):
        assert safe_for_sql(text) == text


def test_a_script_may_not_show_a_secret(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id\n1\n")
    text = "v: LOAD id, 'user:hunter22' AS c FROM [lib://datos/in.csv];"
    with pytest.raises(FlowError):
        run_script(spark, text, catalog_of(tmp_path), Secrets({"S": "user:hunter22"}))
    assert run_script(spark, text, catalog_of(tmp_path), Secrets({"S": "id"}))["estado"] == "COMPLETADO"


def test_single_files_keep_what_csv_must_quote(spark, tmp_path):
    rows = [("a,b", 1), ('say "x"', None), (" blank ", 3), (None, 4), ("", 5), ("two\nlines", 6)]
    single_csv(spark.createDataFrame(rows, "t string, n int").repartition(1), tmp_path / "o.csv")
    with (tmp_path / "o.csv").open(newline="") as file:
        got = list(csv.reader(file))
    assert got[0] == ["t", "n"] and sorted(got[1:]) == sorted([t or "", "" if n is None else str(n)] for t, n in rows)
    single_csv(spark.range(1000).repartition(7).sortWithinPartitions("id"), tmp_path / "p.csv")
    assert sorted(map(int, (tmp_path / "p.csv").read_text().split()[1:])) == list(range(1000)) and not list(tmp_path.glob(".parts*"))


def test_script_run_and_publish(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,region,monto\n1,N,100\n2,N,200\n3,S,50\n")
    text = "v: LOAD id, region, monto FROM [lib://datos/in.csv] WHERE monto > 60; r: LOAD region, Sum(monto) AS total, Count(*) AS n RESIDENT v GROUP BY region; STORE r INTO [lib://datos/out.csv] (csv); STORE v INTO [lib://datos/v.txt]; DROP TABLE v;"
    done = run_script(spark, text, catalog_of(tmp_path), Secrets())
    assert done["estado"] == "COMPLETADO" and done["tablas_disponibles"] == ["r"] and len(done["publicaciones"]) == 2
    assert (tmp_path / "out.csv").read_text() == "region,total,n\nN,300,2\n"
    run_script(spark, text, catalog_of(tmp_path), Secrets())  # the same content may be published again
    (tmp_path / "in.csv").write_text("id,region,monto\n1,N,101\n")
    with pytest.raises(FlowError):
        run_script(spark, text, catalog_of(tmp_path), Secrets())
    with pytest.raises(FlowError):
        run_script(spark, "a: LOAD x FROM [lib://remoto/in.csv];", catalog_of(tmp_path), Secrets())


def test_sftp(spark, tmp_path):
    class Client:
        def __init__(self):
            self.files, self.calls = {}, []

        def put(self, source, target):
            self.files[target] = open(source, "rb").read()

        def stat(self, path):
            return type("S", (), {"st_size": len(self.files[path])})

        def posix_rename(self, a, b):
            raise OSError

        def rename(self, a, b):
            if a not in self.files:
                raise OSError
            self.files[b] = self.files.pop(a)

        def remove(self, path):
            del self.files[path]

        def close(self):
            self.calls.append("close")

    client = Client()
    client.files["/d/o.csv"] = b"old"
    done = publish_sftp(spark.range(2), SftpConnection("r", "h", 22, "u", "/d"), "o.csv", Secrets(), Staging(str(tmp_path / "s")), "x", lambda c, s: client)
    assert client.files == {"/d/o.csv": b"id\n0\n1\n"} and client.calls == ["close"] and done.bytes == 7


def test_staging_and_csv_writer(tmp_path):
    staging = Staging(str(tmp_path / "s"))
    staging.folder("a")
    for bad in ("a", "../b", ""):
        with pytest.raises(FlowError):
            staging.folder(bad)
    out = CsvWriter(tmp_path / "x.csv", ["a", "b"])
    assert not (tmp_path / "x.csv").exists()
    out.write([(1, "x,y")])
    out.close()
    assert (tmp_path / "x.csv").read_bytes() == b'\xef\xbb\xbfa,b\r\n1,"x,y"\r\n'


@pytest.mark.parametrize("seed", range(6))
def test_even_parts_from_counts(seed):
    """Skewed, dense and far-apart values: every row is in one part, and no part has twice an even share, but for single values that have."""
    rng = random.Random(seed)
    values = [rng.choice([rng.randrange(100), 10**12 + rng.randrange(5), -(10**15), rng.randrange(-(10**6), 10**6), 77 if seed % 2 else rng.randrange(10**9)]) for _ in range(3000)] + [None] * 7
    asked = []

    def ask(sql):
        asked.append(sql)
        have = [v for v in values if v is not None]
        if "GROUP BY" not in sql:
            return [(min(have), max(have), len(have))]
        low, width, least, most = map(int, re.search(r'- (-?\d+)\) / (\d+)\) AS c FROM .* >= (-?\d+) AND .* <= (-?\d+)', sql).groups())
        return list(collections.Counter((v - low) // width for v in have if least <= v <= most).items())

    cells, total = cells_of(ask, "t", "k", 8)
    conditions = even_predicates(cells, total, "k", 8)
    held = [[v for v in values if meets(c, v)] for c in conditions]
    assert sum(map(len, held)) == len(values) and total == 3000 and len(asked) < 40
    for part in held:
        heaviest = collections.Counter(part).most_common(1)[0][1]
        assert len(part) <= 2 * 3000 / 8 + 7 or heaviest > 3000 / 16


def meets(condition, value):
    """Whether a row with this key meets a condition."""
    if condition.endswith("IS NULL") and value is None:
        return True
    if value is None:
        return False
    return all(value >= int(n) if op == ">=" else value < int(n) for op, n in re.findall(r'(>=|<) (-?\d+)', condition))


def test_even_parts_of_nothing_and_of_other_columns():
    assert cells_of(lambda _: [(None, None, 0)], "t", "k", 4) == ([], 0) and even_predicates([], 0, "k", 4) == ["1 = 1"]
    with pytest.raises(FlowError):
        cells_of(lambda _: [(0.5, 2.5, 9)], "t", "k", 4)
    assert measured_split({"columna": "a", "particiones": 3}, ("a",)) == ("a", 3) and measured_split({"columna": "a", "minimo": 1, "particiones": 3}, ("a",)) is None
    for bad in ({"columna": "b", "particiones": 3}, {"columna": "a", "particiones": 0}, {"columna": "a; drop", "particiones": 3}):
        with pytest.raises(FlowError):
            measured_split(bad, ("a",))


def test_publishing_to_a_store(spark, tmp_path):
    """A connection whose folder is an address: here a mount that only Hadoop's file systems know."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tienda.link./datos", f"file://{tmp_path}")
    catalog = load_catalog(json.dumps({"locales": [{"nombre": "nube", "tipo": "local", "ruta_base": "viewfs://tienda/datos", "allowlist": [{"esquema": "", "tabla": "sub/x.csv", "campos": []}]}]}), inline=True)
    executor = Executor(spark, catalog)
    executor.register("t", spark.createDataFrame([(1, 'a "b", c'), (2, None)], "n int, v string"))
    executor.run(compile_script("STORE t INTO [lib://nube/sub/x.csv] (csv); u: LOAD n, v FROM [lib://nube/sub/x.csv];", ("t",)))
    assert (tmp_path / "sub" / "x.csv").read_text() == 'n,v\n1,"a ""b"", c"\n2,\n' and [p.name for p in (tmp_path / "sub").iterdir() if not p.name.endswith(".crc")] == ["x.csv"]
    assert executor.published[0]["bytes"] == (tmp_path / "sub" / "x.csv").stat().st_size and executor.tables["u"].count() == 2
    publish_store(spark.createDataFrame([(1, 'a "b", c'), (2, None)], "n int, v string"), "viewfs://tienda/datos/sub/x.csv")  # the same content
    with pytest.raises(FlowError) as e:
        publish_store(spark.range(3), "viewfs://tienda/datos/sub/x.csv")
    assert e.value.code == "PUBLISH_CONFLICT" and (tmp_path / "sub" / "x.csv").read_text().startswith("n,v")
    for bad in ("lib://nube/otro.csv", "lib://nube/../x.csv", "lib://nube//etc/x.csv"):
        with pytest.raises(FlowError):
            place_of(catalog, bad)


def test_streaming_sink(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.range(3).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    (tmp_path / "stage").mkdir()
    done = stream_to_csv(stream, tmp_path / "stage", tmp_path / "out.csv")
    assert done.estado == "PUBLICADO" and sorted((tmp_path / "out.csv").read_text().split()) == ["0", "1", "2", "id"]


def test_streaming_parts_come_in_order(spark, tmp_path):
    """One batch for each file, and the rows of a batch in the order of their partitions."""
    for d in ("in", "stage"):
        (tmp_path / d).mkdir()
    for i in range(12):
        spark.range(i * 10, i * 10 + 10, numPartitions=1).write.parquet(str(tmp_path / "tmp" / str(i)))
        part = next((tmp_path / "tmp" / str(i)).glob("part-*.parquet"))
        part.rename(tmp_path / "in" / f"{i:02d}.parquet")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream_to_csv(stream, tmp_path / "stage", tmp_path / "out.csv")
    assert sorted(map(int, (tmp_path / "out.csv").read_text().split()[1:])) == list(range(120))
    assert len(written_parts(spark, f"file://{tmp_path}/stage/parts")) == 12


def test_compile_only_cli(tmp_path, capsys):
    plan, result = tmp_path / "plan.json", tmp_path / "r.json"
    code = main(["--dataflow-script-contenido", "a: LOAD x FROM [lib://c/f.csv];", "--conexiones-contenido", "{}", "--ejecucion-id", "e", "--solo-compilar", "--plan-salida", str(plan), "--resultado", str(result)])
    assert code == 0 and json.loads(plan.read_text())["operaciones"] and json.loads(result.read_text())["estado"] == "COMPILADO"
    assert main(["--dataflow-script-contenido", "a: LOAD x", "--conexiones-contenido", "{}", "--ejecucion-id", "e"]) == 1
    assert '"estado": "ERROR"' in capsys.readouterr().err
