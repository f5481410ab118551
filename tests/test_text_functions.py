"""Scalar Column functions against the reference's tables and edge cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import enrich as EN


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr).first()[0]


@pytest.mark.parametrize("msg,want", [
    (None, False), ("RESOURCE_EXHAUSTED", True), ("quota exceeded", True), ("Error 429", True),
    ("Error 503", True), ("rate limit exceeded", True), ("invalid input", False), ("authentication failed", False),
])
def test_retryable(spark, msg, want):
    assert one(spark, T.is_retryable("x"), msg) is want
    assert EN.is_retryable(msg or "") is want


@pytest.mark.parametrize("msg,want", [
    (None, 0.0), ("Please retry in 12.5s", 12.5), ("retryDelay:10s", 10.0), ("no delay info", 0.0),
    ("retry in 1.5s, then check status", 1.5), ("retry in 12s.", 0.0), ("retry in 12s. retryDelay:7s", 7.0),
    ("retry in 1s2s", 3.0), ("retry in 0", 0.0),
])
def test_retry_delay(spark, msg, want):
    assert one(spark, T.retry_delay_seconds("x"), msg) == pytest.approx(want)
    assert EN.retry_delay(msg or "") == pytest.approx(want)


def test_backoff(spark):
    df = spark.createDataFrame([(0, "x"), (3, "x"), (9, "x"), (1, "retry in 45s"), (1, "retry in 2s")], "a int, m string")
    got = [r[0] for r in df.select(T.backoff_seconds("a", "m")).collect()]
    assert got == [1.0, 8.0, 30.0, 30.0, 2.0]


def _ref_truncate(s: str, n: int = 100) -> str:
    b = s.encode()
    if len(b) <= n:
        return s
    cut = b[:n]
    idx = cut.rfind(b" ")
    if idx > n // 2:
        cut = cut[:idx]
    return (cut + b"...").decode("utf-8", errors="replace")


@pytest.mark.parametrize("text", [
    "a" * 100, "a" * 101, "a" * 50 + " " + "b" * 60, "a" * 51 + " " + "b" * 60, "x" * 150,
    "é" * 60, "word " * 30, "ü" * 49 + " " + "a" * 80,
])
def test_title_truncation(spark, text):
    assert one(spark, T.truncate_bytes("x"), text) == _ref_truncate(text)


@pytest.mark.parametrize("url,want", [
    ("https://t.me/chan", "chan"), ("http://t.me/chan", "chan"), ("t.me/chan", "chan"), ("@chan", "chan"),
    ("chan", "chan"), ("  https://t.me/chan/ ", "chan"), ("", None), ("https://t.me/chan/42", None),
    ("https://", None),
])
def test_channel_name(spark, url, want):
    assert one(spark, T.channel_name("x"), url) == want


def test_page_id(spark):
    link = "https://example.com/a"
    assert one(spark, T.page_id("x"), link) == hashlib.sha256(link.encode()).hexdigest()[:16]


@pytest.mark.parametrize("s,want", [("01:02:03.500", 3723.5), ("02:03,25", 123.25), ("7.5", 7.5),
                                    ("1:2:3:4", 1.0), ("x:1", None)])
def test_vtt_seconds(spark, s, want):
    got = one(spark, T.vtt_seconds("x"), s)
    assert (got is None and want is None) or got == pytest.approx(want)


def test_undated_and_labels(spark):
    df = spark.createDataFrame([(None,), (0,), (1700000000,)], "s long").select(
        F.when(F.col("s").isNotNull(), F.timestamp_seconds("s")).alias("p"))
    got = df.select(T.unix_ts("p"), T.published_label("p")).collect()
    assert [tuple(r) for r in got] == [(T.ZERO_TIME_UNIX, ""), (0, "1970-01-01 00:00:00 UTC"),
                                       (1700000000, "2023-11-14 22:13:20 UTC")]
