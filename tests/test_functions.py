import datetime as dt
import hashlib

from pyspark.sql import functions as F

from firmo.functions import (clean_country, clean_domain, company_key, extract_host, format_currency,
                             format_number, label_truncate, metric_key, parse_count, parse_revenue_text,
                             parse_timestamp_multi, parse_year, title_case)


def one(spark, expr, value, t="string"):
    return spark.createDataFrame([(value,)], f"v {t}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_keys_match_md5_of_parts(spark):
    df = spark.createDataFrame([(" Apple ", "usa", None)], "n string, c string, t string")
    r = df.select(company_key("n", "c").alias("a"), metric_key("n", "t", "c").alias("b")).first()
    assert r.a == hashlib.md5(b"APPLE|USA").hexdigest()
    assert r.b == hashlib.md5(b"APPLE||USA").hexdigest()   # null part -> ''


def test_clean_domain_and_host(spark):
    assert one(spark, clean_domain, " HTTPS://www.Apple.com/x/y ") == "apple.com"
    assert one(spark, clean_domain, "https://example.com:8080/p") == "example.com:8080"
    assert one(spark, extract_host, "https://www.example.com:8080/path?q=1") == "example.com"
    assert one(spark, extract_host, "") is None
    assert one(spark, extract_host, None) is None


def test_clean_country_aliases_and_quirk(spark):
    got = {v: one(spark, clean_country, v) for v in ["us", "United States", "U.S.", "UK", " united kingdom "]}
    assert got == {"us": "USA", "United States": "USA", "U.S.": "U.S.", "UK": "UK", " united kingdom ": "UK"}
    assert one(spark, clean_country, None) is None


def test_title_case_splits_on_spaces_only(spark):
    assert one(spark, title_case, "APPLE INC") == "Apple Inc"
    assert one(spark, title_case, "AT&T") == "At&t"


def test_format_currency_and_number(spark):
    vals = [(1.5e9,), (250.3e6,), (45200.0,), (999.0,), (1234.5,), (None,)]
    df = spark.createDataFrame(vals, "v double")
    out = [r.c for r in df.select(format_currency("v").alias("c")).collect()]
    assert out == ["1.5B", "250.3M", "45.2K", "999", "1.2K", "-"]
    nums = spark.createDataFrame([(1234567.0,), (None,), (12.5,)], "v double")
    assert [r.c for r in nums.select(format_number("v").alias("c")).collect()] == ["1,234,567", "-", "12.5"]


def test_label_truncate(spark):
    assert one(spark, lambda c: label_truncate(c, 5), None) == "Unkno"
    assert one(spark, lambda c: label_truncate(c, 5), "ABCDEFG") == "ABCDE"


def test_parsers(spark):
    assert one(spark, parse_year, "Founded 1 April 1976; 49 years") == 1976
    assert one(spark, parse_year, "unknown") is None
    assert one(spark, parse_count, "161,000 employees (2024)") == 161000
    assert one(spark, parse_revenue_text, "US$ 391 billion") == 391e9
    assert one(spark, parse_revenue_text, "$5.2 million") == 5.2e6
    assert one(spark, parse_revenue_text, "300 (estimate)") == 300e6   # any 'm' scales by a million (quirk)
    assert one(spark, parse_revenue_text, "n/a") is None


def test_parse_timestamp_multi(spark):
    fb = dt.datetime(2001, 7, 1)
    df = spark.createDataFrame([("2024-03-05T06:07:08.123456",), ("2024-03-05T06:07:08",), ("n/a",), ("",)], "v string")
    got = [r.t for r in df.select(parse_timestamp_multi("v", fb).alias("t")).collect()]
    assert got == [dt.datetime(2024, 3, 5, 6, 7, 8, 123456), dt.datetime(2024, 3, 5, 6, 7, 8), fb, fb]
