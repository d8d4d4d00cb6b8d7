import pytest

#: Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with those of the operators.
LONG = "one two three four five six seven eight nine ten eleven twelve. " * 400
COMMON = "This line stands in many documents, word for word, again and again."
TEXTS = [
    (1, f"{COMMON}\nAlpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "a"),
    (2, f"  {COMMON.upper()} \nSome other text that nobody else has written down so far.", "en", "a"),
    (3, f"{COMMON}\n\n{COMMON}", "en", None),
    (4, None, None, "b"),
    (5, "", "en", "b"),
    (6, LONG, "en", "b"),
    (7, LONG, None, "b"),
    (8, "der die das und nicht ein eine mit von zu auf für über können müßte", "de", "c"),
    (8, "der die das und nicht ein eine mit von zu auf für über können müßte", "de", "c"),
    (9, "!!! 123 ... ???", "de", "c"),
    (10, "日本語 текст mixed 😀 input\twith tabs  and spaces \n", None, None),
    (None, "A row without an id is a document too.", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    for name in ("id", "key", "size", "part", "n", "copies", "h1", "host", "bands", "n_chars"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
