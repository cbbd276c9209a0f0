import math

import pytest
from pyspark.sql import functions as F

from packetloom.contract import Thresholds
from packetloom.functions.rules import clamp_fraction, label_text, window_label
from packetloom.functions.text import clean_category, first_value, is_attack_word, parse_numeric, safe_name
from packetloom.functions.time import (
    duration_text,
    fallback_window_key,
    iso_text,
    iso_time,
    seconds_since_window_end,
    window_key,
)

NUMBERS = {
    None: None, "": None, " ": None, "N/A": None, "<NaN>": None, "None": None, "nan": None, "na": None,
    "12": 12.0, " 12.5 ": 12.5, "\t3\n": 3.0, "+5": 5.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "-0.5": -0.5, "1.5E-2": 0.015,
    "true": 1.0, "YES": 1.0, "No": 0.0, "False": 0.0, "yes|2": 1.0,
    "0x1F": 31.0, "0x0": 0.0, "0xFFFFFFFFFFFFFFFFFF": float(int("F" * 18, 16)),
    "0x20000000000001": float(int("20000000000001", 16)),
    "0x80000000000004000000000000001": float(int("80000000000004000000000000001", 16)),
    "0x" + "f" * 300: None, "0X1F": None, "0x": None, "-0x1F": None, "0x1G": None,
    "7|8;9": 7.0, "5;6": 5.0, "5|6;7": 5.0, "|4": None, "none|3": None, ";1": None,
    "1,2": None, "12d": None, "12f": None, "1_000": None, "HTTP/1.1": None, "abc": None, "1 2": None,
    "inf": math.inf, "-Infinity": -math.inf, "+INF": math.inf, "1E400": None, "-1E400": None, "--5": None, "1e": None,
}


def test_parse_numeric(spark):
    rows = [(i, t) for i, t in enumerate(NUMBERS)]
    df = spark.createDataFrame(rows, "i int, t string")
    found = {r.t: r.n for r in df.select("t", parse_numeric("t").alias("n")).collect()}
    assert found == NUMBERS


def test_parsing_many_columns_agrees_with_one(spark):
    from packetloom.operators.typing import type_columns

    df = spark.createDataFrame([(i, t) for i, t in enumerate(NUMBERS)], "i int, t string")
    both = df.select("i", "t", F.col("t").alias("u"), parse_numeric("t").alias("one"), clean_category("t").alias("cat"))
    rows = type_columns(both, ["t", "absent"], ["t", "u", "absent", "gone"], keep=["one", "cat"]).collect()
    for r in rows:
        assert r.t == r.one and r.u == r.cat
        assert r.absent is None and r.gone == "__MISSING__"


def test_numbers_are_not_parsed_again(spark):
    from packetloom.operators.typing import type_columns

    df = spark.createDataFrame([(1, 2.5, 7), (2, float("nan"), None)], "i int, d double, b bigint")
    rows = type_columns(df, ["d"], ["d", "b"], keep=["i"]).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [(1, 2.5, "7"), (2, None, "__MISSING__")]


def test_first_value_and_category(spark):
    df = spark.createDataFrame([("a ;b|c",), (" x; y",), ("plain",), (" Null ",)], "t string")
    rows = df.select(first_value("t").alias("f"), clean_category("t").alias("c")).collect()
    assert [r.f for r in rows] == ["a ;b", "x", "plain", " Null "]
    assert [r.c for r in rows] == ["a ;b|c", "x; y", "plain", "__MISSING__"]


def test_attack_words(spark):
    df = spark.createDataFrame([(" Normal ",), ("BENIGN",), ("0",), ("false",), ("DDoS",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(is_attack_word("t")).collect()] == [0, 0, 0, 0, 1, 1, 1]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-01-01T10:00:00+02:00", "2026-01-01T08:00:00+00:00"),
        ("2026-01-01T10:00:00Z", "2026-01-01T10:00:00+00:00"),
        (" 2026-01-01T10:00:00 ", "2026-01-01T10:00:00+00:00"),
        ("20260101T100000", "2026-01-01T10:00:00+00:00"),
        ("2026-01-01", "2026-01-01T00:00:00+00:00"),
        ("junk", None),
        ("2026", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(iso_text(iso_time(F.col("t")))).first()[0] == expected


def test_latency_is_null_without_window_end_and_never_negative(spark):
    df = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("2026-01-01T00:00:20Z",), (None,)], "e string")
    at = F.timestamp_seconds(F.lit(1767225610))
    assert [r[0] for r in df.select(seconds_since_window_end(F.col("e"), at)).collect()] == [10.0, 0.0, None]


def test_duration_text(spark):
    cases = {59.94: "59.9s", 61.0: "1m 1.0s", 0.25: "0.2s", 0.35: "0.3s", 3600.0: "60m 0.0s", None: "n/a", math.nan: "n/a"}
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    assert [r[0] for r in df.select(duration_text(F.col("v"))).collect()] == list(cases.values())
    text = spark.createDataFrame([("12",), ("x",)], "v string")
    assert [r[0] for r in text.select(duration_text(F.col("v"))).collect()] == ["12.0s", "n/a"]


def test_keys_and_names(spark):
    df = spark.createDataFrame([("", "f.json"), ("k", "f.json"), (None, None)], "s string, o string")
    keys = [r[0] for r in df.select(fallback_window_key(F.col("s"), F.col("o"), 3)).collect()]
    assert keys == ["f.json", "k", "window_000003"]
    row = spark.range(1).select(
        window_key(F.lit(7), F.to_timestamp(F.lit("2026-01-02 03:04:05"))), safe_name(F.lit("a b/c?.pcap"))
    ).first()
    assert tuple(row) == ("window_000007_20260102_030405.json", "a_b_c_.pcap")


def test_window_rule(spark):
    rule = Thresholds(0.5, 0.5, 0.4, 10)
    df = spark.createDataFrame(
        [(9, 1.0, 1.0), (10, 0.4, 0.5), (10, 0.39, 0.9), (10, 0.9, 0.49), (10, 0.9, None)], "n int, r double, m double"
    )
    label = window_label(F.col("n"), F.col("r"), F.col("m"), rule)
    rows = df.select(label.alias("l"), label_text(label).alias("t")).collect()
    assert [r.l for r in rows] == [0, 1, 0, 0, 0]
    assert [r.t for r in rows][:2] == ["BENIGN", "ATTACK"]
    assert (clamp_fraction(-1), clamp_fraction(2), clamp_fraction(0.3)) == (0.0, 1.0, 0.3)
