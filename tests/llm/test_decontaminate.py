import hashlib
import re

from spendlake.llm import decontaminate
from tests.llm.conftest import words

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
ITEMS = "item_id long, text string, doc_id long, hash long"


def plain(docs, items, window=13):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = {}
    for item, text in items:
        w = tok(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = tok(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= own
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(found), names, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, docs_of, docs, items, **options):
    table = spark.createDataFrame([(*x, None, None) for x in items], ITEMS)
    rows = decontaminate.contamination(docs_of(docs), table, **options).collect()
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, sorted(r.item_ids), r.contaminated) for r in rows]


def test_windows_of_every_length(spark, docs_of):
    item = words(11, 30)
    w = item.split()
    items = [(1, item), (2, "Two  words"), (2, "Two  words"), (3, "solo"), (4, ""), (5, None), (None, "lost item"), (12, words(3, 13)), (13, item.upper())]
    docs = [
        (1, item), (2, "intro, " + "; ".join(w[5:18]).upper() + " outro"), (3, " ".join(w[:12])), (4, None), (5, ""),
        (6, words(4, 3000) + " " + item + " " + words(5, 200)), (7, words(4, 100) + " two words solo two, words"),
        (None, item), (8, "two"), (9, " ".join(w[:13] + w[6:19])), (10, words(3, 13)), (10, words(3, 13)), (11, "été solo ünï"),
        (14, "lost item"), (15, "words two " * 50 + "solo " * 300),
    ]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(run(spark, docs_of, docs, items), key=key) == sorted(plain(docs, items), key=key)


def test_no_items_and_no_documents(spark, docs_of):
    assert sorted(run(spark, docs_of, [(1, "some words"), (2, None)], [])) == [(1, 2, 0, 0, [], False), (2, 0, 0, 0, [], False)]
    assert run(spark, docs_of, [], [(1, "some words")]) == []


def test_items_without_id_as_the_sql_has_them(spark, tmp_path):
    from spendlake.llm.catalog import QUERIES
    from spendlake.llm.oracle import ORACLE
    from tests.check import differences
    import duckdb

    item = words(21, 16)
    items = [(None, item), (None, "short one"), (3, item), (None, "short one"), (4, None)]
    docs = [(1, item), (2, "a short one " * 3), (3, "clean"), (4, None), (5, words(5, 400) + " short one"), (6, " ".join(item.split()[1:15]))]
    connection = duckdb.connect()
    for name, rows, schema in (("benchmark", items, "item_id long, text string"), ("documents", docs, "doc_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = QUERIES["op7_decontamination"](spark, str(tmp_path))
    assert differences(got, connection, ORACLE["op7_decontamination"]) == []


def test_item_digest(spark):
    row = spark.sql("SELECT array('10', '2') AS x, array() AS y")
    got = row.select(decontaminate.item_digest(row.x), decontaminate.item_digest(row.y.cast("array<string>"))).first()
    assert list(got) == [hashlib.sha256(s).hexdigest() for s in (b"10,2", b"")]


def test_each_row_has_its_own_verdict(docs_of):
    item = words(7, 20)
    rows = [(None, item), (None, words(8, 50)), (None, None), (2, item), (2, words(9, 50)), (3, item), (4, "clean")]
    items = docs_of([]).sparkSession.createDataFrame([(1, item, None, None)], ITEMS)
    docs = docs_of(rows)
    for odd in (docs, docs.withColumn("own_row", docs.doc_id).withColumn("bad_row", docs.doc_id)):
        kept = decontaminate.drop_contaminated_rows(odd, items)
        assert kept.columns == odd.columns
        assert {(r.doc_id, r.text) for r in kept.collect()} == {x for x in rows if x[1] != item}
        assert kept.count() == 4
