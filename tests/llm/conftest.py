import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key string, n int, h1 string"


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use too."""

    def make(rows, partitions=3):
        data = [(i, t, "en", "s", len(t or ""), "x", "x", 1, "x") for i, t in rows]
        return spark.createDataFrame(data, DOCS).repartition(partitions)

    return make
