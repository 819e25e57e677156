"""The registered queries: thin adapters from the operators to the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.bloom_lm import language_scores
from spendlake.llm.common import hex64, read_input
from spendlake.llm.decontaminate import contamination, item_digest
from spendlake.llm.exact_dedup import deduplicate
from spendlake.llm.hard_negatives import hard_negatives
from spendlake.llm.html_text import extract_text
from spendlake.llm.importance import resample
from spendlake.llm.mixing import mix
from spendlake.llm.phrases import collocations
from spendlake.llm.quality import judge_quality
from spendlake.llm.secret_ledger import BASE_RULES, secrets, span_list
from spendlake.llm.simhash import near_duplicates
from spendlake.llm.toxicity import toxicity
from spendlake.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    spans = F.col("spans")

    def count(name: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter(spans, lambda s: s["rank"] < len(BASE_RULES))
    return secrets(docs).select(
        F.col("path").alias("doc_id"),
        *(count(rule.name) for rule in BASE_RULES),
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(spans).alias("spans"),
    )


@query
def op2_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read_input(spark, sf_dir, "labels").filter("quality = 1")
    return resample(read_input(spark, sf_dir, "documents"), good)


#: Share of tokens wanted of each language.
MIX_TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents and their language, the domain to predict for all others."""
    labels = read_input(spark, sf_dir, "labels").select("doc_id").distinct()
    docs = read_input(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("domain"))
    return docs.join(labels, "doc_id")


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents").select("doc_id", "text")
    return mix(docs, labelled_domains(spark, sf_dir), MIX_TARGETS, leave_out=("text",))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_input(spark, sf_dir, "documents"), read_input(spark, sf_dir, "labels"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read_input(spark, sf_dir, "documents"))
    return groups.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(read_input(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("posterior", 6).alias("posterior"),
    )


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(
        read_input(spark, sf_dir, "documents"), read_input(spark, sf_dir, "benchmark")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        item_digest(F.col("item_ids")).alias("items_sha256"),
        "contaminated",
    )


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_input(spark, sf_dir, "pages")).drop("url")


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(read_input(spark, sf_dir, "documents"))


@query
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_input(spark, sf_dir, "pages"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(spark, f"{sf_dir}/documents.parquet")


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_input(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_input(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(rows, F.col("id") % 50 == 0)
