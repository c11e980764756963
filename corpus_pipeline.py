"""Corpus pipeline: quality rules, line dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet to the
shared folder and read again as the next stage's documents. All but the last
return the columns of ``documents``. SQL can express neither the forest nor the
packing, so ``ORACLE_SQL`` is None and tests hold the stages against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import decontaminate
from tessera.llm.frames import staged
from tessera.llm.line_runs import dedup_lines
from tessera.llm.minmax_dedup import keep_one
from tessera.llm.packing import pack
from tessera.llm.quality_forest import keep_good
from tessera.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the isolation forest."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a smaller doc_id has; ``n_chars`` follows the text."""
    out = dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates (five words, 0.8)."""
    return keep_one(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens, with their ids."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
