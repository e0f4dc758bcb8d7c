import pytest

from cardwatch.llm.common import stored

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " kept boolean, score double, row_key bigint, fp bigint, row bigint, ids string"
)


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (id, text) or (id, text, lang), with extra columns of clashing names, written
    and read back as the operators expect."""

    def build(rows, parts=3):
        full = []
        for row in rows:
            i, text, lang = (*row, "en")[:3]
            full.append((i, text, lang, "s", len(text or ""), None, 0.5, 7, 7, 7, "x"))
        return stored(spark.createDataFrame(full, SCHEMA).repartition(parts), "test-documents")

    return build


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\f "),
    (None, "a text without an id"),
    (None, "a text without an id"),
    (4, "the same row"),
    (4, "the same row"),
    (5, None, None),
    (6, "один два три 日本語 \U0001f600 é x"),
    (7, "word " * 30_000),
    (8, "=" * 5_000),
]


@pytest.fixture(scope="session")
def odd(table):
    return table(ODD)


@pytest.fixture(scope="session")
def empty(table):
    return table([])
