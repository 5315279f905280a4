"""Paths in any store that Hadoop knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = hadoop_path(spark, path)
    return files.exists(where)


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    where, files = hadoop_path(spark, path)
    return files.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    where, files = hadoop_path(spark, path)
    files.delete(where, True)


def store_of(spark: SparkSession, path: str):
    """A path and its file system; local files are read and written without checksum files beside them, as other programs share them."""
    where, files = hadoop_path(spark, path)
    return where, files.getRawFileSystem() if files.getUri().getScheme() == "file" else files


def digest_of(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """A file's size and SHA-256, or None if there is no file."""
    where, files = store_of(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return files.getFileStatus(where).getLen(), spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def copy_into(spark: SparkSession, out, path: str) -> None:
    where, files = store_of(spark, path)
    stream = files.open(where)
    try:
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
    finally:
        stream.close()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file into place at once, over one that is there."""
    jvm, to_path = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    where, files = hadoop_path(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(to_path(source)), files.makeQualified(where), how)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no folder."""
    where, files = hadoop_path(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []
