import hashlib
import hmac

import duckdb
from pyspark.sql import functions as F

from demandcast.functions.hashing import DEFAULT_SALT, hmac_sha256_hex
from demandcast.plans.oracle import hmac_sql


def py_hmac(text, salt=DEFAULT_SALT):
    if text is None:
        return None
    return hmac.new(salt.encode(), text.encode(), hashlib.sha256).hexdigest()


def test_known_value_of_default_salt(spark):
    df = spark.createDataFrame([("C001",)], "id string")
    got = df.select(hmac_sha256_hex("id").alias("h")).first()["h"]
    assert got == "0061b988bc8dbdd5320579a61a92e6e998c02b269b73cbba458c7fbf7e3fb6b2"


def test_matches_python_hmac(spark):
    values = ["K7", "K07", "", "Zoë-ß-東京", None, "x" * 300, "a\x00b"]
    df = spark.createDataFrame([(v,) for v in values], "id string")
    digests = set()
    for salt in ["rye", "s" * 64, "s" * 100, "ключ"]:  # up to and beyond the block of SHA-256
        got = [r["h"] for r in df.select(hmac_sha256_hex(F.col("id"), salt).alias("h")).collect()]
        assert got == [py_hmac(v, salt) for v in values]
        digests.update(h for h in got if h)
    assert len(digests) == 4 * 6  # every id and every salt gives another one


def test_numeric_ids_hash_their_text(spark):
    df = spark.createDataFrame([(123,)], "id long")
    got = df.select(hmac_sha256_hex("id").alias("h")).first()["h"]
    assert got == py_hmac("123")


def test_duckdb_expression_agrees():
    for text in ["C001", "Zoë", ""]:
        got = duckdb.sql(f"SELECT {hmac_sql(repr(text))}").fetchall()[0][0]
        assert got == py_hmac(text)
