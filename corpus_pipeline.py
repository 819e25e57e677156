"""The corpus job: filters, deduplicates, decontaminates, redacts and weighs ``documents``.

Each stage gets the documents that the stage before it kept, as a table written to the shared
scratch folder and read again, and its decisions take effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendlake.llm.catalog import MIX_TARGETS, labelled_domains
from spendlake.llm.common import materialize, read_input
from spendlake.llm.decontaminate import drop_contaminated_rows
from spendlake.llm.mixing import mix
from spendlake.llm.secret_ledger import redact_secrets
from spendlake.llm.simhash import one_row_of_each_group
from spendlake.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model does not reject."""
    return drop_toxic(docs, read_input(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the least id."""
    return one_row_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return drop_contaminated_rows(docs, read_input(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets redacted."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their domain and the rate that meets the target weights."""
    return mix(docs, labelled_domains(spark, sf_dir), MIX_TARGETS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: The first and the last stage are fitted models, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_input(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
