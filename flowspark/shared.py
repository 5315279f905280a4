"""The folder that driver and executors share, and tables that are kept there while a job goes on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address in spark.checkpoint.dir, which is set here only where it is unset and the session is local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="flowspark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept_in(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """df as it was when it was written to the shared folder, and where it lies; the loss of an executor costs nothing of it."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def kept(df: DataFrame, name: str) -> DataFrame:
    return kept_in(df, name)[0]
