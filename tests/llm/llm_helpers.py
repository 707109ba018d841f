"""Small tables and brute-force versions shared by the tests of the subpackage."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, extra=""):
    """rows of (doc_id, text[, source]) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """The table with columns named like operators' own and outputs."""
    from pyspark.sql import functions as F

    names = ["fp", "root", "key", "score", "kept", "component_id", "_row", "_id", "_text", "n_words", "bucket", "_key", "TEXT", "found", "a"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def random_text(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rng(seed=1):
    return random.Random(seed)
