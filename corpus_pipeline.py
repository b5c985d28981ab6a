"""Documents from raw to mixed: each stage is one operator, written as Parquet and read again by the next.

Every stage keeps rows that have equal or null ids apart: rows are known by their place in the files that
the stage before has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, mixing, ngram_join, pii, quality_lines
from millrace.llm.columns import keyed, shield
from millrace.session import load_table, write_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    model = quality_lines.fit(docs, load_table(spark, sf_dir, "labels"))
    inner, restore = shield(docs, ["text"])
    return restore(quality_lines.label_documents(inner, model).filter("quality_lines.kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest id; documents without an id come last."""
    inner, restore = shield(docs, ["doc_id", "text"])
    rows = keyed(inner)
    found = write_once(ngram_join.join(rows.select("row_key", "doc_id", "text"))).rows
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("x"))
    gone = found.join(first.select(F.col("x.row_key").alias("row_key")), "row_key", "left_anti").select("row_key")
    return restore(rows.join(gone, "row_key", "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    inner, restore = shield(docs, ["text"])
    rows = keyed(inner)
    found = decontamination.judge(rows.select("row_key", "text"), load_table(spark, sf_dir, "benchmark"))
    return restore(rows.join(found.filter("n_hit > 0").select("row_key"), "row_key", "left_anti"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and the length counted anew."""
    inner, restore = shield(docs, ["text"])
    out = restore(pii.mark(inner, replace=True))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time; ``copy`` counts from 1."""
    inner, restore = shield(docs, ["doc_id", "source", "text"])
    rows = keyed(inner)
    mixed = mixing.mix(rows.select("row_key", "doc_id", "source", mixing.words().alias("size")))
    taken = mixed.filter("copies > 0").select("row_key", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return restore(rows.join(taken, "row_key"), "copy")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: Line labelling, redaction and balanced draws aren't expressed in SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir)).rows
    return STAGES[-1][1](spark, docs, sf_dir)
