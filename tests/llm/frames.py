"""Small odd tables for the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "ba be bi bo bu da de di do du".split()


def prose(rng, n, vocabulary=WORDS):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, copies, repeated rows."""
    rng = random.Random(3)
    text = prose(rng, 80)
    rows = [
        (1, text, "en", "a", 9), (2, text, "en", "a", 9), (2, text, "en", "a", 9), (3, None, "en", "b", None), (4, "", "de", "b", 0),
        (5, " \t\n ", None, None, 4), (None, prose(rng, 60), "de", "a", 1), (6, prose(rng, 30_000), "en", None, 1),
        (7, text + " ba", "de", "c", 2), (8, "été Straße слово ελλην 12", None, "c", 3), (None, None, None, None, None),
    ]
    return rows


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def clashing(df, *names):
    """The frame with extra columns of the names that operators use."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit(name))
    return df
