"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the documents that the next one works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import drop_stash, stash, table
from flowspark.llm.linededup import drop_repeated_lines
from flowspark.llm.minhash import drop_near_copies
from flowspark.llm.mixing import mix
from flowspark.llm.packing import pack
from flowspark.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier line; documents with no words left go."""
    done = drop_repeated_lines(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in done.columns else done


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, a similarity of 0.8 or more."""
    return drop_near_copies(docs, words=5, percent=80, rows=4, bands=37)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' targets take them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL can't express the trained tagger or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_stash(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
