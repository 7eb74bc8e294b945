import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, part int, uid bigint"


def frame(spark, rows, parts=3):
    """Documents with more columns, some named as the operators name their own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1, 7) for i, t in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="session")
def awkward():
    """Null and empty texts, white space alone, a very long text, one without white space, repeated rows, equal and near texts, null ids, special characters."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    base = " ".join(word() for _ in range(120))
    near = base.replace(base.split()[60], "changed", 1)
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, base), (5, base), (5, base), (6, base.replace(" ", "\n ", 3)), (7, near), (8, near.upper()), (9, "one two"), (10, "one two three"), (11, "ONE two  three"), (12, " ".join(word() for _ in range(20000))),
        (13, "x" * 50000), (None, "no id at all, but a text"), (None, base), (14, "漢字 🙂 <|endoftext|> it's 12"), (15, "Licensed under the Apache License, Version 2.0."), (16, "a"), (17, "a"), (18, " nbsp wide"), (19, base + " tail"),
    ]


@pytest.fixture(scope="session")
def docs(spark, awkward):
    return frame(spark, awkward).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [(1, "x")]).filter("doc_id < 0")
