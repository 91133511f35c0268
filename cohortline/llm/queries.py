"""The queries that apply each operator to its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import decontaminate, language_id, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, sharding, spelling, suffix_dedup, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the declared language is ``lang``, the host is the source."""
    documents = table(spark, sf_dir, "documents")
    return language_id.identify(documents, declared=F.col("lang"), host=F.col("source"))


def llm_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: the markup's language, the address's suffix and host."""
    pages = language_id.page_evidence(table(spark, sf_dir, "pages"))
    return language_id.identify(
        pages, "page_id", declared=F.col("declared"), host=F.col("host"), suffix=F.col("suffix")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_classifier.score(documents, quality_classifier.train(documents, table(spark, sf_dir, "labels")))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(warc.write_archive(table(spark, sf_dir, "pages")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_recurring(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "llm_page_language": llm_page_language,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_near_dedup": op6_near_dedup,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_sharding": op13_sharding,
}
ORACLE_SQL: dict[str, str] = {
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op13_sharding": sharding.ORACLE_SQL,
}
