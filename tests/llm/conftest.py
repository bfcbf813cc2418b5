import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, row_number string, fingerprint string"
PASSAGE = (
    "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions near the old stone bridge and "
    "nobody in the village below ever asks why the river glows green at night or hums a tune that every child knows by heart. "
)
LONG = PASSAGE * 2 + "A closing line that stands alone in this text, with number 12345 and some more words to fill it up."


def make(spark, texts, ids=None):
    """Documents with the given texts, ids from 0, and extra columns whose names operators might use."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", "y", "z") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def odd(spark):
    """Null, empty and blank texts, copies, rows repeated with their ids, a null id, one very long text."""
    texts = [None, "", " \n\t", "Hello world", "Hello world", LONG, LONG, LONG.upper(), "é" * 500, "word " * 30_000, "only two", "日本語 テキスト"]
    ids = [0, 1, 2, 3, 3, 5, 6, 7, 8, 9, None, 11]
    return make(spark, texts, ids)


@pytest.fixture
def none(spark):
    return make(spark, [])
