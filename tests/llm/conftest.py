import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def prose(seed, n, vocabulary=2000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    passage = prose(1, 60)
    rows = [
        (1, f"{prose(2, 40)}\n{passage}\n{prose(3, 30)}"), (2, f"{passage} {prose(4, 50)}"), (3, None), (4, ""),
        (5, " \t\n\r\v\f "), (6, passage), (6, passage), (7, passage.upper()), (8, "one"), (9, "x" * 5000),
        (10, " ".join(["tick tock"] * 400)), (11, prose(5, 30000)), (12, "é中\U0001f600 " * 60),
        (13, f"{passage}\n{passage}"), (None, prose(6, 80)), (14, "  " * 40), (15, "<|endoftext|> don't 12.5% \\ [ < |"),
    ]
    names = "start size key kind node shard row word length rank part line lines kept n_words n_lines stratum of u v one two".split()
    frame = spark.createDataFrame([(d, t, "en" if (d or 0) % 2 else None, "s", len(t or "")) for d, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
