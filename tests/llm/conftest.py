import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, body string, key string, node string, words string"


def row(doc_id, text):
    return (doc_id, text, "en", None, None if text is None else len(text), "x", "y", "z", "n", "w")


@pytest.fixture(scope="session")
def small_docs():
    """Ordinary texts, copies, near copies and shared passages, with every edge case among them."""
    pick = random.Random(7)
    vocabulary = ["".join(pick.choice("abcdefghij") for _ in range(pick.randint(1, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(pick.choice(vocabulary) + pick.choice(["", "", "", ".\n", ","]) for _ in range(n))

    base = [prose(pick.randint(5, 120)) for _ in range(25)]
    shared = prose(70)
    texts = list(base)
    texts += [base[3], base[3], base[4].upper()]
    texts += [base[k].replace(vocabulary[k], vocabulary[k + 1]) for k in range(10)]
    texts += [f"{prose(10)} {shared} {prose(15)}" for _ in range(5)]
    texts += ["", None, " \n\t ", "\n", "a", "a a a a a a a a a a a a", "Ünï çødé ß 字 😀\x00\x85 x", "line\nline\nline\nline"]
    texts += [prose(20_000), " ".join(["same words again"] * 3000), "x" * 50_000]
    rows = [row(k, text) for k, text in enumerate(texts)]
    rows += [row(2, base[2]), row(2, base[5]), row(None, base[6]), row(None, None), row(-5, base[7])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, small_docs):
    return spark.createDataFrame(small_docs, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
