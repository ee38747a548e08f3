import pytest

#: Texts that exercise edges: null, empty, white space of all kinds, control strings, long runs, other scripts, repeats.
ODD = [None, "", " ", "  a", "a  b", "a \n b", "\n\n x", "a\t b", "x <|endoftext|> y", "日本 語 ", "don't  we'll", "a\x1c b", "a  b", "é́ x", "q" * 5000 + " z", "w" + " " * 3000 + "x", "x " * 40_000, "same words here again", "same words here again"]


@pytest.fixture
def odd_documents(spark):
    rows = [(i, t, "en", None, i) for i, t in enumerate(ODD)] + [(None, "no id", None, "s", 0), (3, "  a", "en", None, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, n_tokens long")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
