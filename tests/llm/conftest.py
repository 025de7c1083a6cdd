import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use themselves.
CLASHES = ("score", "kept", "component_id", "digest", "x", "u", "v", "n", "band", "type", "pos", "_k", "_m", "tie")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rng = random.Random(5)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    far = " ".join([*words[:30], *prose(rng, 90).split()])
    rows = [
        (1, base, "en"), (2, near, "en"), (3, base.upper(), None), (4, far, "de"), (5, None, "en"), (6, "", "en"), (7, " \n\t ", None),
        (8, "one two three", "en"), (9, "one two three", "en"), (10, "one two four", None), (11, prose(rng, 30000), "fr"),
        (2, near, "en"), (None, base, "en"), (None, None, None), (12, "été où ça", "fr"), (13, "a  b c <|endoftext|> ▁ 日本 \x1c z", "x"),
        (14, ("same line of eight words right here now\n") * 40, "en"), (15, "### $$$ %% " * 30, "en"),
    ]
    df = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], SCHEMA).repartition(3)
    for c in CLASHES:
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
