"""From raw documents to packed training sequences, one operator per stage.

Every stage takes the documents that the one before it kept, as a written table, and
all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm import decontaminate, line_templates, packing, rules, simhash
from headway.llm.frames import text_session, written
from headway.llm.queries import tokenizer_path


def _as_given(docs: DataFrame, added: tuple, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` with the columns of ``docs``; those that it would overwrite wait under private names."""
    private = {c: f"__given_{c}" for c in docs.columns if c in added}
    out = run(docs.withColumnsRenamed(private))
    return out.select(*(F.col(private.get(c, c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules keep."""
    labels = text_session(spark).read.parquet(f"{sf_dir}/labels.parquet")

    def kept(given: DataFrame) -> DataFrame:
        measures = written(rules.measured(given), "measures")
        # A row per stratum, as a written table: Spark sees its size before it joins.
        learned = written(rules.learned(measures, labels), "rules")
        return rules.judged(measures, learned).filter("kept")

    return _as_given(docs, (*rules.COUNTS, "base_failed", "kept"), kept)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of templates that an earlier document has; n_chars follows."""
    text_session(spark)
    return _as_given(docs, ("n_lines", "n_dropped"), line_templates.without_recurring_lines)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that differ in two bits at most."""
    text_session(spark)
    return simhash.one_of_each(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    text_session(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    text_session(spark)
    return packing.pack(docs, tokenizer_path(), capacity=2048)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("decontamination", decontamination), ("packing", packed)]

#: None: fingerprints and packing are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
