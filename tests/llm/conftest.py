import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """documents rows from (id, text) or (id, text, lang, source)."""

    def make(rows, parts=3):
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts)

    return make


@pytest.fixture()
def clashing(make_docs):
    """Extra columns named as operators name their own."""

    def make(rows):
        df = make_docs(rows)
        for c in ("row", "sha", "h", "key", "size", "score", "t_key", "maybe", "kept", "copies", "odd.name"):
            df = df.withColumn(c, df["doc_id"] + 1)
        return df

    return make
