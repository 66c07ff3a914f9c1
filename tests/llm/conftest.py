"""Documents with every oddity: nulls in any column, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, shard int, bucket int, k string"


def prose(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 6))) for _ in range(n))


def odd_rows() -> list[tuple]:
    r = random.Random(3)
    base = prose(r, 80)
    texts = [None, "", " \n\t ", "one", "Two WORDS", base, base, base + " tail", base.upper(), prose(r, 20_000), "naïve ßtraße 中文 ٣ end\x00of", "a,b;c " * 30, "!!! ###", base.replace(" ", "\n", 10)]
    texts += [prose(r, r.randint(1, 200)) for _ in range(30)]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s2", "s3", None]), len(t) if t else None, 7, "x", 1, 2, "k") for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
