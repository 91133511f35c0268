"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and
read back as the next stage's input, so a stage's decisions are final and a lost executor
costs the running stage only. All stages but the last return the columns of documents.

Nulls, empty texts, repeated rows and empty tables are as each operator's module states.
Columns beyond those of documents are passed on by every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from cohortline.llm.queries import table, tokenizer_path
from cohortline.llm.store import Store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence."""
    decisions = language_id.identify(docs, declared=F.col("lang"), host=F.col("source"))
    return language_id.accepted(docs, decisions)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates."""
    return line_dedup.drop_recurring(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates."""
    return near_dedup.one_of_each(docs, near_dedup.link(docs, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Tokenising and the language model cannot be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = Store(docs, "pipeline")
    for name, stage in STAGES:
        docs = store.write(stage(spark, docs, sf_dir), name)
    return docs
