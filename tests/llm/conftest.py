"""Documents with everything that may go wrong, and the registered queries over a small table."""

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
ODD = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, block int, kept string, "
    "n long, set_id long, label string, score double, place long, guest int, counts string, element long"
)
PASSAGE = " ".join(f"word{i}" for i in range(120))


def odd_rows():
    texts = [
        (1, "An ordinary text, said once. It has a few words of its own."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, "one"),
        (6, f"first {PASSAGE} then"),
        (7, f"second {PASSAGE} and more"),
        (8, "copy of this text " * 3),
        (8, "copy of this text " * 3),
        (9, "copy of this text " * 3),
        (None, "no id here"),
        (None, None),
        (10, "aaaa" * 500),
        (11, "naïve façade 日本語 テキスト   x y 🙂"),
        (12, "long " + " ".join(f"w{i % 977}" for i in range(60_000))),
        (13, "<|endoftext|> stays   <|endoftext|>text"),
        (14, PASSAGE.upper()),
    ]
    return [(i, t, *[None] * 14) for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the small table, by id."""
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy(F.col("doc_id")).collect()]


@pytest.fixture(scope="session")
def result(spark):
    """A registered query's rows as dictionaries."""
    from claimweave.llm import queries

    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = [r.asDict() for r in queries.queries()[name](spark, SF_DIR).collect()]
        return kept[name]

    return run
