import random

import pytest

#: Names the operators use inside, so that clashes show.
CLASHES = (
    "row_id string, blob int, spans int, fp int, component_id int, score int, rate string, domain int, n_tokens int, "
    "posterior int, kept int, kept_id int, kept_copies int, bad_id int, n_words int, path int, n int, p int, toxic int, "
    "x0 int, held int, link int, hash int, window int, words int, size int, count int, digest int, body int"
)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``, with clashing extra columns."""

    def make(rows):
        extra = (None,) * (len(CLASHES.split(",")))
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]), *extra) for r in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return make


#: Null and empty texts, null ids, ties, repeated rows, blanks only, a very long text and a long word.
def edge_rows():
    long = words(1, 60_000)
    copy = words(2, 80)
    return [
        (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "one"), (5, "ONE"), (6, long), (7, copy), (8, copy), (8, copy),
        (9, copy + " extra"), (None, "no id here at all"), (None, None), (10, "x" * 2_000_000), (11, "Ünïcode Ünïcode été ſK"),
        (12, "one two"), (13, "\x00\x01 nul ퟿"), (14, "a\n\na\na \n\nb"),
    ]


@pytest.fixture(scope="session")
def edge(docs_of):
    return docs_of(edge_rows())


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def labels_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, domain string")

    return make
