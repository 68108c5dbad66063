import pytest

# Texts that every operator has to take: null, empty, blanks only, ties, repeats, very long.
ODD_TEXTS = [
    None, "", "  \t\n ", "one", "one two", "One  TWO", "one two three four", "one two three four",
    "café Über \U0001f600 naïve", "a" * 5000, "x y " * 3000, " nbsp em space",
    "0 1 2 3 !!! ???", "\x0b\x0c", "it's we'll  they've\r\n\r\n  done",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts as documents: nulls in every column, a repeated row, columns of clashing names."""
    rows = [(n, text, ["en", None, "fr"][n % 3], "s", len(text or ""), "a", 1, b"x")
            for n, text in enumerate(ODD_TEXTS)]
    rows += [rows[6], (None, "no id here at all", None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long,"
              " fingerprint string, size int, shard binary").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture
def corpus(spark, tmp_path):
    """Writes texts as the documents table of a scale folder."""
    def write(texts, name="scale"):
        rows = [(n, text, "en", "s", len(text or "")) for n, text in enumerate(texts)]
        folder = str(tmp_path / name)
        spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
            f"{folder}/documents.parquet")
        return folder

    return write
