import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spendlake.llm.common import materialize, read_input
from spendlake.llm.decontaminate import contamination
from spendlake.llm.secret_ledger import secrets
from spendlake.llm.simhash import near_duplicates
from tests.llm.conftest import edge_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = read_input(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        out[name] = docs
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name, df in stages.items():
        assert df.columns[:5] == COLUMNS
        assert name == "mixing" or df.columns == COLUMNS


def test_decisions_take_effect(spark, sf_dir, stages):
    docs = read_input(spark, sf_dir, "documents")
    assert set(ids(stages["toxicity"])) < set(ids(docs))
    groups = near_duplicates(stages["toxicity"]).select("component_id").distinct().collect()
    assert ids(stages["near_duplicates"]) == sorted(r.component_id for r in groups)
    judged = contamination(stages["near_duplicates"], read_input(spark, sf_dir, "benchmark"))
    assert ids(stages["decontamination"]) == ids(judged.filter("not contaminated"))
    assert judged.filter("contaminated").count() > 0
    assert ids(stages["secrets"]) == ids(stages["mixing"]) == ids(stages["decontamination"])
    left = secrets(stages["secrets"].select(F.col("doc_id").alias("path"), "text"))
    assert left.filter(F.size("spans") > 0).count() == 0
    assert stages["secrets"].filter("n_chars <> length(text)").count() == 0
    assert stages["mixing"].filter("rate is null or rate < 0").count() == 0


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert ids(corpus_pipeline.run(spark, sf_dir)) == ids(stages["mixing"])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, sf_dir, edge, name, stage):
    docs = edge.select(*COLUMNS)
    out = stage(spark, docs, sf_dir)
    assert out.columns[:5] == COLUMNS and 0 < out.count() <= len(edge_rows())
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
