"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau über señor œuvre".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", "\n"]) for _ in range(n))


def texts() -> list[str | None]:
    passage = prose(99, 60)
    return [
        None, "", " \n\t ", "x", "ÀÉ", "12 34", prose(1, 50), prose(1, 50), prose(2, 400), passage, prose(3, 80) + "\n" + passage + "\n" + prose(4, 80),
        passage + prose(5, 30), "ab " * 3000, "z" * 5000, prose(6, 6000), "\U0001f600 emoji \U0001f601", "<|endoftext|> it's 1ct don't", "line\n" * 40, "A\nB\nC\nD", "A\nB\nC\nE", prose(7, 300), prose(7, 300) + " tail",
    ]


def rows() -> list[tuple]:
    """Every text once, one row repeated, one doc_id with two texts, one row without an id."""
    found = [(k, t, ("en", "de", None)[k % 3], "s", None if t is None else len(t)) for k, t in enumerate(texts())]
    return [*found, found[8], (3, prose(8, 20), "en", None, 1), (None, prose(9, 120), "de", "s", 2)]


def documents(spark, data=None):
    """The rows with extra columns whose names clash with those the operators use inside."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    return df.selectExpr("*", "1 as h", "'x' as fp", "2 as bucket", "3 as start", "4 as th", "5 as block", "6 as part")
