from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tablesync.functions import (
    error_text,
    file_field_refs,
    json_count,
    log_timestamp,
    lower_snake,
    quoted,
    redact,
    snake_name,
    stable_digest,
    stable_hash,
    try_double,
    try_number,
)

NAMES = [
    ("OrderID", "order_id"), ("HTTPStatusCode", "http_status_code"), ("already_snake", "already_snake"),
    ("with space-and.dots", "with_space_and_dots"), ("__x__y__", "x_y"), ("", "field"),
    ("--", "field"), ("2nd", "_2nd"), ("v2Name", "v2_name"), ("ABC", "abc"), ("aB", "a_b"),
    ("naïveName", "na_ve_name"), ("A1B2", "a1_b2"),
]


@pytest.mark.parametrize("name, wanted", NAMES)
def test_snake_name(name, wanted):
    assert snake_name(name) == wanted


def test_lower_snake_column_agrees(rows):
    frame = rows("name string, wanted string", *NAMES)
    assert frame.where(lower_snake(F.col("name")) != F.col("wanted")).collect() == []


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("got  Bearer abc.DEF-1=\n then", "got Bearer <redacted> then"),
        ("read gs://b/k and S3://x/y", "read <redacted-uri> and <redacted-uri>"),
        ("GET https://host/path?q=1 failed", "GET <redacted-uri> failed"),
        ("from @DB.SCHEMA.STAGE/path/file", "from @<redacted-stage-path>"),
        ("password = 'hun ter' x", "password = <redacted> x"),
        ("token:abc secret=\"a b\" private_key=k", "token:<redacted> secret=<redacted> private_key=<redacted>"),
        ("plain text\ttabs", "plain text tabs"),
        ("   ", ""),
    ],
)
def test_redact(rows, text, wanted):
    assert rows("t string", (text,)).select(redact(F.col("t"))).first()[0] == wanted


def test_error_text(rows):
    def shown(text, limit=500):
        frame = rows("t string", (text,))
        return frame.select(error_text(F.lit("E"), F.col("t"), limit)).first()[0]

    assert shown("boom") == "E: boom"
    assert shown("") == "E"
    assert shown("x" * 9000, None) == "E: " + "x" * 9000
    assert shown("x" * 500) == "E: " + "x" * 500
    assert shown("x" * 501) == "E: " + "x" * 497 + "..."
    assert shown("x" * 495 + " yz" + "q" * 9) == "E: " + "x" * 495 + " y..."
    assert shown("x" * 496 + " yz" + "q" * 9) == "E: " + "x" * 496 + "..."


def test_file_field_refs():
    assert file_field_refs('f($1:"Col A", $1:b) + $1:"q""x"') == 'f(`Col A`, `b`) + `q"x`'
    assert quoted("a`b.c") == "`a``b.c`"


def test_tolerant_casts(rows):
    frame = rows("t string", ("12.5",), ("-3",), ("x",), (None,))
    got = frame.select(try_number(F.col("t")).cast("int"), try_double(F.col("t"))).collect()
    assert [tuple(row) for row in got] == [(13, 12.5), (-3, -3.0), (None, None), (None, None)]


def test_json_count(rows):
    frame = rows("j string", ('[1,{"a":2}]',), ("[]",), ("{}",), (None,))
    assert [row[0] for row in frame.select(json_count(F.col("j"))).collect()] == [2, 0, 0, 0]


def test_log_timestamp(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2026-01-02 03:04:05.000067' AS t")
    assert frame.select(log_timestamp(F.col("t"))).first()[0] == "2026-01-02 03:04:05.000067"


def test_stable_hash(spark):
    value = {"b": [1, 2], "a": "x"}
    text = json.dumps(value, sort_keys=True, separators=(",", ":"))
    wanted = hashlib.sha256(text.encode()).hexdigest()[:16]
    assert stable_digest(value, 16) == wanted
    assert spark.range(1).select(stable_hash(F.lit(text), 16)).first()[0] == wanted
