"""Derby databases in files: one JVM at a time may write such a database, any number may read a sealed one.

Tasks on other machines can't open a database that the driver's JVM has open. So tasks write the rows as files of the shared folder, which the database takes by its own
bulk import, file by file, and tasks read from a sealed copy there: a JAR, which Derby opens for reading only. No row passes through Spark's driver or Python.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import FlowError
from ..shared import shared_folder
from ..sinks.store import hadoop_path, names_in, remove
from ..types import column

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
#: Databases in files. In-memory ones are for sessions of one JVM, those with // behind a server.
IN_FILES = re.compile(r"jdbc:derby:(?!memory:|jar:|classpath:|//)([^;]+)")
TYPES = {"boolean", "byte", "short", "integer", "long", "float", "double", "decimal", "string", "char", "varchar", "date", "timestamp", "timestamp_ntz"}


def new_database() -> str:
    """The address of a new database on the driver's disk."""
    return f"jdbc:derby:{os.path.realpath(tempfile.mkdtemp(prefix='flowspark-derby-'))}/db;create=true"


def connect(spark: SparkSession, url: str):
    return spark._jvm.java.sql.DriverManager.getConnection(url)


def text(value: str | None) -> str:
    """A value as a literal of SQL."""
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


RESERVED = "derby.storage.pageReservedSpace"


@contextmanager
def full_pages(spark: SparkSession, url: str) -> Iterator[None]:
    """Tables that are created meanwhile fill their pages: they are loaded once, so that no space (a fifth by default) is kept for rows that grow."""
    connection = connect(spark, url)
    try:
        found = connection.createStatement().executeQuery(f"VALUES SYSCS_UTIL.SYSCS_GET_DATABASE_PROPERTY({text(RESERVED)})")
        found.next()
        before, put = found.getString(1), lambda value: connection.createStatement().execute(f"CALL SYSCS_UTIL.SYSCS_SET_DATABASE_PROPERTY({text(RESERVED)}, {text(value)})")
        found.close()
        put("0")
        try:
            yield
        finally:
            put(before)
    finally:
        connection.close()


def table_exists(spark: SparkSession, url: str, table: str) -> bool:
    connection = connect(spark, url)
    try:
        return connection.getMetaData().getTables(None, None, table, None).next()
    finally:
        connection.close()


def line(df: DataFrame) -> Column:
    """A row as a line of the import: values in quotes, which are doubled inside, nothing for a null."""
    if bad := [f.name for f in df.schema if f.dataType.typeName() not in TYPES]:
        raise FlowError(f"Tipos sin carga por archivos: {bad}", "JDBC_IMPORT_TYPE")
    quoted = [F.concat(F.lit('"'), F.replace(column(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in df.columns]
    return F.concat_ws(",", *[F.coalesce(q, F.lit("")) for q in quoted]).alias("value")


def bulk_load(df: DataFrame, url: str, schema: str | None, table: str) -> None:
    """Append df to a table that is there. Each file is read by the database as a stream."""
    spark = df.sparkSession
    folder = shared_folder(spark, "import")
    df.select(line(df)).write.text(folder)
    connection = connect(spark, url)
    try:
        for name in names_in(spark, folder):
            where, files = hadoop_path(spark, f"{folder}/{name}")
            if not name.startswith("part-") or not files.getFileStatus(where).getLen():
                continue
            local = where.toUri().getPath()
            if files.getUri().getScheme() != "file":
                local = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="flowspark-import-")), name)
                files.copyToLocalFile(False, where, spark._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), True)
            statement = connection.createStatement()
            statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE({text(schema)}, {text(table)}, {text(local)}, ',', '\"', 'UTF-8', 0)")
            statement.close()
            if local != where.toUri().getPath():
                shutil.rmtree(os.path.dirname(local))
            files.delete(where, False)
    finally:
        connection.close()
        remove(spark, folder)


def sealed(spark: SparkSession, url: str) -> str:
    """Close a database and move it to the shared folder, where all tasks may read it by the address returned. The folder has to be mounted where tasks run."""
    place = IN_FILES.match(url)[1]
    try:
        connect(spark, f"jdbc:derby:{place};shutdown=true")
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # what Derby says when a database has been closed
            raise
    shared = shared_folder(spark, "database")
    if "://" in shared and not shared.startswith("file://"):
        raise FlowError("La base sellada necesita una carpeta compartida montada", "JDBC_SHARED_FOLDER")
    target = shared.removeprefix("file://") + ".jar"
    os.makedirs(os.path.dirname(target), exist_ok=True)
    own = os.path.basename(os.path.dirname(place)).startswith("flowspark-derby-")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as jar:  # stored, as pages are read from any place
        for root, _, names in os.walk(place):
            for name in names:
                if not name.endswith(".lck"):
                    jar.write(path := os.path.join(root, name), os.path.join("db", os.path.relpath(path, place)))
                    if own:  # a table at a time is there twice; another's database stays whole until its copy is
                        os.remove(path)
    shutil.rmtree(os.path.dirname(place) if own else place)
    return f"jdbc:derby:jar:({target})db"
