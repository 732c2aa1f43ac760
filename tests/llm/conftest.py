import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _blob string, key int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with two more columns whose names clash with ones the operators use inside."""

    def make(texts, langs=None):
        rows = [(i, t, langs[i] if langs else "en", "s", None if t is None else len(t), "x", i) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, ties, repeated rows, control characters, a word without end, a very long text."""
    rng = random.Random(5)
    words = [rng.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]) + str(rng.randrange(400)) for _ in range(9000)]
    passage = " ".join(words[:60])
    return [
        None, "", " \t\n ", "one", passage, passage, f"start {passage} end of it all", "x" * 30000, " ".join(words), "the " * 300,
        "a\x1cb\x85c d\x0be", "ünï çödé 日本語 ½ <|endoftext|> <|im_end|>", passage.replace("alpha", "omega"), "퟿\U0001f600 ok",
    ]


@pytest.fixture(scope="session")
def repeated_rows():
    """The table with its first rows once more, ids and all."""

    def repeat(df):
        return df.unionByName(df.where(F.col(df.columns[0]) < 8))

    return repeat
