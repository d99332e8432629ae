import pytest

import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    return compare.session()


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns, among them names that operators use themselves."""

    def build(rows):
        full = [(i, t, *(rest or ("en",)), "src", len(t or "")) for i, t, *rest in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        return df.selectExpr("*", "1 AS node", "'x' AS words", "2 AS score", "3 AS batch", "4 AS h", "5 AS n", "6 AS shard")

    return build


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, repeats, a long text, white space of all kinds."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    texts = [None, "", " ", "a", "A b", "a  b\n\n c\t d ", "<|endoftext|> x", "it's 'll　y\x1c.z", "▁ mark▁", "é ñ ß 😀 \x00", long, long, "one two three four five"]
    return [*enumerate(texts), (7, texts[7]), (None, "no id here"), (None, None)]
