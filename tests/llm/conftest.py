import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark):
    """Rows by (doc_id, text) as a table of documents, with an extra column."""

    def make(rows, lang=None):
        data = [(i, t, lang, "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS n_tokens", "'x' AS value")

    return make


ODD = ["", None, "a", " ", "  two  spaces ", "\n\nlines\n\n \n x\n", "tab\there\r\nand there ", "Don't stop 12345 <|endoftext|> now", "é" * 5000, "word " * 3000, "日本語のテキスト。", "x y　z  q", "ΣΊΣΥΦΟΣ Σ İstanbul ½ ² Ⅷ", "a\x1cb \x85 c", "😀 emoji 👩‍👩‍👧 é", "same", "same", "A" * 20000]


@pytest.fixture(scope="session")
def odd_texts():
    return ODD


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
