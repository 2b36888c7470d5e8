import pytest

from clicktide.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    """The given documents as a dict by doc_id."""
    rows = queries.table(spark, SF_DIR, "documents").collect()
    return {r.doc_id: r for r in rows}


EDGE_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "the cat sat on the mat " * 30,
    "the cat sat on the mat " * 30,
    "Ünïcode 😀 wörds and spaces\n\nagain  and again",
    "x" * 20000,
    "1 " * 5000,
    "<|endoftext|> <|im_end|> &amp; <|",
]


@pytest.fixture
def edge_documents(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names operators use inside."""
    names = "part ids fp found start kind spans base quality tail score lang_pred tie".split()
    rows = [(i, t, *([f"extra {i}"] * len(names))) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "a text without an id", *([None] * len(names))), rows[4], rows[4], (4, "another text of id 4", *([None] * len(names)))]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
