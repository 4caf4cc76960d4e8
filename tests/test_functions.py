"""Semantics that differ from Spark's defaults, and column jobs, on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import coins, common as c, hexwords as h, labels
from tidemark.operators.rows import split_rows


def one(df, col):
    return df.select(col.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def row(spark):
    return spark.createDataFrame([(1, None, "a/b")], "a int, b int, s string")


def test_null_strict_functions(row):
    assert one(row, c.greatest_strict("a", "b")) is None
    assert one(row, c.least_strict("a", F.lit(0))) == 0
    assert one(row, c.concat_ws_strict("-", "s", "b")) is None
    assert one(row, c.concat_ws_strict("-", "s", "a")) == "a/b-1"


def test_part_zero_is_one(row):
    assert one(row, c.part("s", "/", 0)) == "a"
    assert one(row, c.part("s", "/", 2)) == "b"
    assert one(row, c.part("s", "/", 3)) == ""


def test_full_match(row):
    assert one(row, c.full_match("s", "a")) is False
    assert one(row, c.full_match("s", "a/b|x")) is True


def test_ordering_of_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    assert [r.a for r in df.orderBy(c.newest("a")).collect()] == [None, 2, 1]
    assert [r.a for r in df.orderBy(c.oldest("a")).collect()] == [1, 2, None]


def test_surrogate_key_spells_out_null(spark):
    import hashlib

    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert one(df, c.surrogate_key("a", "b")) == hashlib.md5(b"x-_dbt_utils_surrogate_key_null_").hexdigest()


def test_base64(row):
    assert one(row, c.base64_text(F.lit("YWN0aW9u"))) == "action"
    assert one(row, c.base64_text(F.lit("%%"))) is None


@pytest.mark.parametrize("text,amount,denom", [
    ("123usei", 123, "usei"), ("5usei,3x", 5, "usei,3x"), ("7ibc/27A", 7, "ibc/27A"), ("abc12", None, "abc12"), ("", None, ""), ("1" * 40 + "u", int("1" * 38), "u"),
])
def test_coin(spark, text, amount, denom):
    df = spark.createDataFrame([(text,)], "t string")
    got = one(df, coins.coin_amount("t"))
    assert (None if got is None else int(got)) == amount
    assert one(df, coins.coin_denom("t")) == denom


def test_rate(spark):
    df = spark.createDataFrame([("0.5usei",)], "t string")
    assert float(one(df, coins.rate_amount("t"))) == 0.5
    assert one(df, coins.rate_denom("t")) == "usei"


def test_split_coins(spark):
    df = spark.createDataFrame([("10usei,5gamm/pool/1,3ibc/AB,4",)], "t string")
    got = coins.split_coins(df, "t").groupBy("currency").agg(F.sum("amount").alias("a")).collect()
    assert {r.currency: int(r.a) for r in got} == {"usei": 14, "gamm/pool/1": 5, "ibc/AB": 3}


NUMBERS = [0, 1, 2**60 - 1, 2**60, 2**63, 2**64, 2**120, 2**126, 10**38 - 1, 10**38, 2**200 + 12345, 2**255, 2**256 - 5, 2**256 - 1]


def test_hex_numbers(spark):
    df = spark.createDataFrame([("0x%064x" % n, str(n)) for n in NUMBERS] + [("zz", None), ("", None), (None, None)], "h string, n string")
    for r in df.select("n", h.hex_to_number("h").alias("d"), h.hex_to_text_number("h").alias("t"), h.signed_hex_to_number("h").alias("s")).collect():
        if r.n is None:
            assert (r.d, r.t, r.s) == (None, None, None)
            continue
        n = int(r.n)
        signed = n - 2**256 if n >= 2**255 else n
        assert r.t == r.n
        assert (None if r.d is None else int(r.d)) == (n if n < 10**38 else None)
        assert (None if r.s is None else int(r.s)) == (signed if abs(signed) < 10**38 else None)


@pytest.mark.parametrize("raw,d,want", [("123456789", 6, "123.456789"), ("5", 3, "0.005"), ("1000", 3, "1"), ("7", 0, "7"), ("-5", 1, "-0.5"), ("1" + "0" * 60, 18, "1" + "0" * 42)])
def test_decimal_adjust(spark, raw, d, want):
    df = spark.createDataFrame([(raw, d)], "r string, d int")
    assert one(df, h.decimal_adjust("r", "d")) == want


def test_hex_texts_and_words(spark):
    df = spark.createDataFrame([("0x" + "00" * 12 + "ab" * 20 + "cd" * 32 + "ff",)], "h string")
    assert one(df, F.size(h.hex_words("h"))) == 2
    assert one(df, h.topic_address(h.word(h.hex_words("h"), 0))) == "0x" + "ab" * 20
    assert one(df, h.word(h.hex_words("h"), 5)) is None
    assert one(df, h.hex_to_text(F.lit("0x41424300"))) == "ABC"
    assert one(df, h.hex_to_text(F.lit("0xzz"))) is None


def test_dynamic_array(spark):
    words = [7, 64, 3, 10, 20, 30]
    df = spark.createDataFrame([("".join("%064x" % w for w in words),), ("".join("%064x" % w for w in [7, 64, 0]),)], "h string")
    got = [r.x for r in df.select(h.dynamic_array(h.hex_words("h"), 1).alias("x")).collect()]
    assert [[int(w[0], 16) for w in g] for g in got] == [[10, 20, 30], []]


def test_usd_outlier(spark):
    df = spark.createDataFrame([(100.0, 10.0, True), (100.0, 90.0, True), (100.0, 10.0, False), (100.0, None, True), (0.0, 0.0, True)], "a double, b double, s boolean")
    got = [r.x for r in df.select(c.usd_unless_outlier("a", "b", "s").alias("x")).collect()]
    assert got == [None, 100.0, 100.0, None, 0.0]


def test_pool_names(spark):
    a, b = "0x" + "1" * 40, "0x" + "2" * 40
    df = spark.createDataFrame([("ABC", None, a, b)], "s0 string, s1 string, t0 string, t1 string")
    assert one(df, labels.pool_label([("s0", "t0"), ("s1", "t1")], F.lit(3000), F.lit(None).cast("int"), "X LP")) == "ABC-0x222...2222 3000 0 X LP"
    assert one(df, labels.pair_name(F.lit("b"), F.lit("a"))) == "a-b"


def test_split_rows(spark):
    df = spark.createDataFrame([("a,b,,c",)], "t string")
    assert [r.p for r in split_rows(df, "t", ",", "p").collect()] == ["a", "b", "", "c"]
