import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a Parquet table of several files, as the operators read them."""
    made = []

    def make(data, schema, parts=3):
        path = f"{tmp_path}/table-{len(made)}"
        made.append(path)
        df = spark.createDataFrame(data, schema)
        (df.repartition(parts) if data else df).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def docs_of(stored):
    """Documents from texts or (doc_id, text, source) tuples, with extra columns of names that operators use."""

    def make(items, parts=3, clash=True):
        rows = []
        for k, x in enumerate(items):
            doc_id, text, source = x if isinstance(x, tuple) else (k, x, "s")
            rows.append((doc_id, text, "en", source, None if text is None else len(text), "r", "f", -1, -2, "x", "y", 0.5))
        extra = ", _row string, fp string, size int, score int, ranges string, kind string, position double"
        df = stored(rows, DOCS + extra, parts)
        return df if clash else df.select("doc_id", "text", "lang", "source", "n_chars")

    return make
