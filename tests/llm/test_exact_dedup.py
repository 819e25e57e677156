import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spendlake.llm.exact_dedup import StreamDedup, deduplicate, normalised
from tests.llm.conftest import DOCS, edge_rows, words


def plain(rows):
    """``(doc_id, keep_id, group_size, sha)`` of every row and the number of kept rows by text."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.extend((i, keep, len(ids), sha) for i in ids)
    return sorted(out, key=str), len(groups)


def got(df):
    rows = df.collect()
    found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows]
    return sorted(found, key=str), sum(r.kept for r in rows)


def weak(text):
    """Two digests for all texts."""
    return F.when(F.length(text) % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))


@pytest.fixture
def stored(docs_of, tmp_path):
    def write(rows, name="docs", mode="append"):
        docs_of(rows).repartition(3).write.mode(mode).parquet(str(tmp_path / name))
        return str(tmp_path / name)

    return write


@pytest.mark.parametrize("options", [{}, {"digest": weak}, {"batch_bytes": 1}])
def test_edge_rows(spark, stored, options):
    path = stored(edge_rows())
    assert got(deduplicate(spark, path, **options)) == plain(edge_rows())


def test_exactly_one_row_of_a_group_stays(spark, stored):
    rows = [(3, "a b"), (1, "a\tb"), (1, "a  b"), (None, "a\n b"), (None, "c"), (None, " c"), (None, "c")]
    result = deduplicate(spark, stored(rows))
    assert got(result) == plain(rows)
    kept = result.filter("kept").groupBy("text_sha256").count()
    assert kept.filter("count <> 1").isEmpty() and kept.count() == 3


def test_later_files_meet_the_kept_state(spark, stored, tmp_path):
    first, second = [(10, "one"), (11, "two")], [(5, " one"), (12, "one"), (13, "three"), (14, "two")]
    path, root = stored(first), str(tmp_path / "state")
    run = StreamDedup(spark, path, root)
    run.ingest()
    assert got(run.result()) == plain(first)
    run.ingest()  # nothing new
    assert run.groups().agg(F.sum("n")).first()[0] == 2
    stored(second)
    again = StreamDedup(spark, path, root)  # another run of the job
    again.ingest()
    assert got(again.result()) == plain([*first, *second])


def test_leading_blank_is_part_of_the_text(spark):
    rows = spark.createDataFrame([(" a\t\tb \n",), ("a b",), (None,)], "text string")
    assert [r[0] for r in rows.select(normalised(F.col("text"))).collect()] == [" a b ", "a b", ""]


def test_hot_group_and_shared_digests(spark, stored):
    copy = words(3, 40)
    rows = [(i, copy if i % 3 else words(100 + i, 5)) for i in range(3000)]
    assert got(deduplicate(spark, stored(rows), digest=weak)) == plain(rows)


def test_empty_table_and_single_file(spark, stored, none, tmp_path):
    path = str(tmp_path / "none")
    none.coalesce(1).write.parquet(path)
    assert deduplicate(spark, path).count() == 0
    one = next((tmp_path / "none").glob("*.parquet"))
    assert deduplicate(spark, str(one)).count() == 0


def test_no_python_in_the_plan(spark, stored, plan_of):
    stream = StreamDedup(spark, stored(edge_rows()), str(spark.conf.get("spark.checkpoint.dir")) + "/plan")
    stream.ingest()
    plan = plan_of(stream.result()) + plan_of(stream.shared_digests(stream.rows(), stream.groups()))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_session_settings_stay(spark, stored):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    deduplicate(spark, stored([(1, "a")]))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_schema(spark, stored):
    assert "text string" in DOCS
    assert deduplicate(spark, stored([(1, "a")])).dtypes == [
        ("doc_id", "bigint"), ("keep_id", "bigint"), ("group_size", "bigint"), ("kept", "boolean"),
        ("text_sha256", "string"),
    ]
