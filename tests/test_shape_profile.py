import pytest
from pyspark.sql import functions as F

from packetloom.contract import FeatureContract
from packetloom.operators import profile, shape
from packetloom.operators.calibrate import baseline, thresholds_of, usable_windows
from packetloom.contract import Thresholds


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("﻿ip.src ", "x", "ip_src", " x")
    clean = shape.normalize_columns(df)
    assert clean.columns == ["ip_src", "x", "ip_src_2"] and tuple(clean.first()) == (1, 2, 3)


def test_align_keeps_provenance_and_raw_values(spark):
    contract = FeatureContract(["n", "c", "gone"], ["n", "gone"], ["c"])
    df = spark.createDataFrame([("0x10", " v ", "f1", "t")], "n string, c string, source_file string, frame_time string")
    row = shape.align_to_contract(df, contract, ["frame_time", "c", "absent"]).first()
    assert row.asDict() == {"source_file": "f1", "frame_time": "t", "raw_c": " v ", "n": 16.0, "c": "v", "gone": None}
    assert shape.align_to_contract(df.drop("source_file"), contract).first().source_file == "unknown"


def test_large_windows_become_several_documents(spark):
    rows = [(("2024-01-01 00:00:00" if i % 3 else "2024-01-01 01:00:00"), i, None if i % 2 else "v") for i in range(900)]
    df = spark.createDataFrame(rows, "w string, i int, f string").withColumn("w", F.to_timestamp("w"))

    def build(limit):
        return shape.window_documents(df, "w", ["i"], ["i", "f"], window_seconds=3600, records_per_document=limit)

    whole, parts = build(10_000).collect(), build(100).collect()
    assert sorted(d.record_count for d in whole) == [300, 600]
    assert len(parts) > 8 and max(d.record_count for d in parts) < 200
    assert len({d.stream_file for d in parts}) == len(parts)
    assert sorted(int(r.i) for d in parts for r in d.records) == list(range(900))
    first = min(whole, key=lambda d: d.window_start)
    assert [int(r.i) for r in first.records] == [i for i in range(900) if i % 3]
    assert {r.f for r in first.records} == {"", "v"} and first.stream_file == "window_000000_20240101_000000.json"


@pytest.mark.parametrize("limit", [1_000_000, 70])
def test_parts_are_the_window_in_order(spark, limit):
    """Equal order values and rows, a null window and a window that fits: the parts one after the other are the whole window."""
    rows = [("2024-01-01 00:00:00", i // 300, f"v{i % 7}") for i in range(900)] + [("2024-01-01 01:00:00", i, "x") for i in range(30)]
    df = spark.createDataFrame([*rows, *[(None, 1, None)] * 60], "w string, i int, f string").withColumn("w", F.to_timestamp("w"))

    def build(records):
        return shape.window_documents(df, "w", ["i"], ["i", "f"], window_seconds=3600, records_per_document=records, limit=limit)

    whole, parts = ({(d.window_start, d.first_record): d.records for d in build(n).collect()} for n in (10_000, 40))
    assert max(map(len, parts.values())) == 40 and len(parts) == 23 + 1 + 2
    for start, first in whole:
        assert first == 0
        own = sorted((f, records) for (s, f), records in parts.items() if s == start)
        assert [f for f, _ in own] == [40 * i for i in range(len(own))]
        assert [r for _, records in own for r in records] == whole[start, 0]
    numbers = {(r.window_start, r.record_index) for r in shape.explode_records(build(40), ["window_start"]).collect()}
    assert numbers == {(start, i) for (start, _), records in whole.items() for i in range(len(records))}


def test_first_values_of_all_columns(spark):
    """Nulls first and NaN last in the order, ties by text, missing words and NaN values left out, numbers as text."""
    nan = float("nan")
    places = [3.0, None, nan, 1.0, 1.0, 2.0, None, 0.5, nan, 7.0]
    rows = [(p, i % 4, None if i % 3 == 0 else f" t{9 - i} ", nan if i < 8 else float(i), "n/a") for i, p in enumerate(places)]
    df = spark.createDataFrame(rows, "p double, k int, t string, x double, gone string").repartition(3)
    found = {r["column"]: r.v for r in profile.first_values(df, ["t", "x", "gone", "k"], ["p"], "v").collect()}

    def place(p):
        return (0, 0) if p is None else (2, 0) if p != p else (1, p)

    def first(shown):
        return " | ".join(v.strip() for _, v in sorted((place(p), v) for p, v in shown)[:5])

    assert found["t"] == first([(r[0], r[2]) for r in rows if r[2] is not None])
    assert found["k"] == first([(r[0], str(r[1])) for r in rows])
    assert found["x"].split(" | ") == ["9.0", "8.0"] and "gone" not in found


def test_records_with_nulls(spark):
    schema = "k string, records array<struct<a: string, b: int>>"
    df = spark.createDataFrame([("x", [("1", None), None]), ("empty", []), ("null", None)], schema)
    clean = shape.stringify_records(df)
    rows = {r.k: r.records for r in clean.collect()}
    assert [tuple(r) for r in rows["x"]] == [("1", "")] and rows["empty"] == [] and rows["null"] == []
    exploded = {(r.k, r.record_index, r.a) for r in shape.explode_records(clean, ["k"]).collect()}
    assert exploded == {("x", 0, "1"), ("empty", None, None), ("null", None, None)}
    preview = clean.select("k", *shape.preview_columns()).where("k = 'empty'").first()
    assert (preview.record_preview_count, preview.records_truncated) == (0, False)


def test_flatten_skips_arrays(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'c', named_struct('d', 2)) AS a, array(1) AS l")
    assert shape.flatten(df).columns == ["a_b", "a_c_d", "l"]
    assert shape.flatten(df, ".").columns == ["a.b", "a.c.d", "l"]


def test_union_needs_frames():
    with pytest.raises(ValueError):
        shape.union_by_name([])


def test_prune_and_typing(spark):
    rows = [("1", "a", "n/a", "x", "5", "1"), ("2", "b", "", "x", "0x5", "1.0"), (None, None, None, "x", "5.0", None)]
    df = spark.createDataFrame(rows, "num string, cat string, empty string, const string, same string, one string")
    numeric, categorical, empty, constant = profile.prune_columns(profile.column_facts(df, df.columns))
    assert (numeric, categorical) == (["num"], ["cat"])
    assert empty == ["empty"] and constant == ["const", "same", "one"]
    assert profile.drop_empty_constant(df, df.columns).columns == ["num", "cat"]


def test_missing_category_counts_as_a_value(spark):
    df = spark.createDataFrame([("tcp",), (None,)], "c string")
    assert profile.prune_columns(profile.column_facts(df, ["c"]))[1] == ["c"]


def test_labels(spark):
    with pytest.raises(ValueError):
        profile.binary_labels(spark.range(1).toDF("x"))
    df = spark.createDataFrame([("2", "normal"), ("x", "DoS"), (None, "DoS")], "Attack_label string, Attack_type string")
    labelled, source = profile.binary_labels(df)
    assert source == "Attack_label" and [r.label for r in labelled.collect()] == [1, 0, 0]


def test_compare_flags(spark):
    left = spark.createDataFrame([(1, "0", "5", "q"), (2, "0", "6", None)], "o int, zero string, v string, only string")
    right = spark.createDataFrame([(1, "3", "12", None), (2, "4", "12", "")], "o int, zero string, v string, extra string")
    columns = ["zero", "v", "only", "extra"]
    report = profile.compare_profiles(
        profile.column_profile(left, columns, "edge", ["o"]), profile.column_profile(right, columns, "local", ["o"])
    )
    rows = {r["column"]: r for r in report.collect()}
    assert rows["v"].range_shift_ratio == 2.0 and rows["zero"].range_shift_ratio is None
    assert rows["v"].local_sample_values == "12 | 12" and rows["v"].edge_median == 5.5
    lists = {tuple(r) for r in profile.drift_lists(report).collect()}
    assert lists == {("edge_only", "only"), ("local_only", "extra"), ("local_constant", "v")}


def test_calibration(spark):
    rule = Thresholds(0.5, 0.5, 0.4, 50)
    rows = [("60", "0.1", "0.9"), ("70", "0.2", "0.8"), ("10", "0.9", "0.1"), ("80", "bad", "0.1"), (None, "0.3", "0.3")]
    df = spark.createDataFrame(rows, "records string, attack_record_ratio string, max_attack_probability string")
    row = baseline(df, rule).first()
    assert (row.windows_total, row.windows_used, row.file_ratio_threshold) == (4, 2, 0.4)
    assert row.attack_record_ratio_max == 0.2 and row.max_attack_probability_median == pytest.approx(0.85)
    high = baseline(df, Thresholds(0.5, 0.5, 0.1, 1_000_000), quantile=5.0).first()
    assert (high.windows_used, high.file_ratio_threshold, high.baseline_quantile) == (4, pytest.approx(0.95), 1.0)
    assert thresholds_of(baseline(df, rule)).min_records == 50
    with pytest.raises(ValueError):
        usable_windows(df.drop("records"))
    with pytest.raises(ValueError):
        baseline(df.where("attack_record_ratio = 'bad'"), rule)
