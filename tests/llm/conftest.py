import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept int, `__row` int, h string, score double"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 12
    texts = [(1, None), (2, ""), (3, " \n\t"), (None, "lonely row without an id " * 30), (4, base), (4, base), (5, base + "omega"),
             (6, base.replace("beta", "beta ")), (7, "Ünïcode 漢字 😀 text"), (8, "Ünïcode 漢字 😀 text"), (9, "a" * 5000),
             (10, "w" + " w" * 60000), (11, None), (12, "short one"), (13, "SHORT one")]
    return [(i, t, None if n % 3 else "en", None if n % 4 == 1 else f"s{n % 3}", None, "x", n, None, None, None)
            for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
