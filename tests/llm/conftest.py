import pytest

from starloom.llm.common import importable, table

SMALL = "/root/testdata/sf0.001"
AWKWARD = [
    (1, "", "x"),
    (2, None, "x"),
    (None, "no id here", "x"),
    (4, "same text twice\nand a second line", "x"),
    (4, "same text twice\nand a second line", "x"),
    (5, " \t\n\n ", "x"),
    (6, "word " * 30_000, "x"),
    (7, "a" * 20_000, "x"),
    (8, "héllo wörld 🙂 <|endoftext|> end", "x"),
]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def small(spark):
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash."""
    return spark.createDataFrame(
        [(*row, 0, 0, "c") for row in AWKWARD],
        "doc_id long, text string, hits string, version int, places int, chunks string",
    )


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
