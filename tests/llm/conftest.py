import pytest

#: doc_id, text, lang, source, n_chars and columns whose names operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, label int, node long, "
    "shard int, rank long, part long, key string, number long, content string, f_lines string"
)
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew potions near an old stone bridge "


def row(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), True, 1, 7, 3, 1, 2, "k", 5, "c", "f")


ODD = [
    row(1, PROSE * 5),
    row(2, None),
    row(3, ""),
    row(4, " \t\n "),
    row(5, "one"),
    row(6, "<|endoftext|> ünïcode 한국 😀 \x1c\x85 <|startoftext|>\r\n\r\n  x"),
    row(7, " ".join(f"word{k}" for k in range(30000)), None, None),
    row(8, "same text in two rows " * 20),
    row(8, "same text in two rows " * 20),
    row(9, "same text in two rows " * 20, "b"),
    row(10, "A" * 5000),
    row(11, PROSE * 5 + "extra", "", ""),
    row(12, "tie one two three", "b"),
    row(13, "tie one two three", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every nullable column, empty and long texts, ties, repeated rows, clashing column names."""
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="session")
def texts_of(docs):
    return {r.doc_id: r.text for r in docs.collect()}
