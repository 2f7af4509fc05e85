import pytest

pytest.importorskip("tidemark.llm")

WIDE = "doc_id long, text string, lang string, source string, n_chars long, node long, root long, score double, part int, n long, shard int, hash long, label int"


def wide(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "en", "s", 0, 1, 2, 0.5, 3, 4, 5, 6, 1) for d, t in rows], WIDE)


LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(30_000))
ODD = [
    (1, "one two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, "   \t\n "),
    (5, "one two three four five six seven eight nine ten"),
    (5, "one two three four five six seven eight nine ten"),
    (None, "a text without an id, of some words and more"),
    (None, None),
    (6, LONG),
    (7, "naïve café Ünïcödé \U0001f600   line space ▁ mark  double  spaces\n\nand lines\n"),
    (8, "ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN"),
    (9, "x"),
    (10, "<|endoftext|> a marker"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return wide(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], WIDE)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
