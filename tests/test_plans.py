"""Shape of the plans: what must and must not appear in them."""

import re

from pyspark.sql import functions as F

from packetloom.operators import dashboard, distribution, evaluate, profile, summary
from packetloom.plans import queries
from packetloom.sinks.tables import last_per_key

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_needed(spark):
    text = plan(queries.hourly(spark, FOLDER))
    assert re.search(r"FileScan parquet \[ts#\d+,value#\d+\]", text) and text.count("Exchange ") == 1


def test_user_predicate_reaches_the_scan(spark):
    assert "GreaterThan(value,25.5)" in plan(queries.QUERIES["user_predicate"](spark, FOLDER))


def test_limits_apply_before_the_shuffle(spark):
    rows = queries.scored(spark, FOLDER)
    assert "WindowGroupLimit" in plan(summary.cap_rows(rows, ["w"], ["event_id"], 3))
    assert "WindowGroupLimit" in plan(last_per_key(rows.withColumnRenamed("user_id", "_id"), "_id", ["event_id"]))
    assert "TakeOrderedAndProject" in plan(dashboard.recent(rows, 5, "event_id"))


def test_profile_expands_no_rows(spark):
    rows = queries.lineitem_side(spark, FOLDER)
    text = plan(profile.parse_ratios(rows, ["price", "status", "remark"]))
    assert "Expand" not in text and text.count("Exchange ") == 1
    samples = plan(profile.first_values(rows, ["price", "status", "remark"], ["l_orderkey"], "v"))
    assert samples.count("FileScan") == 1 and "WindowGroupLimit" in samples


def test_no_row_functions_in_python(spark):
    for name in ("parse_numeric_text", "align_contract", "window_documents", "records_explode", "iso_parse"):
        text = plan(queries.QUERIES[name](spark, FOLDER))
        assert "Python" not in text, name


def test_large_curves_are_not_ordered_in_one_task(spark):
    rows = queries.scored(spark, FOLDER)
    large = plan(evaluate.score_curve(rows, "y", summary.PROBABILITY, limit=100))
    # Only the totals of the ranges meet in one partition; scores are ordered within their range.
    assert re.search(r"Window .*\[_range#\d+\], \[score#\d+ DESC", large)
    assert not re.search(r"Window \[sum\(pos#\d+L?\) windowspecdefinition\(score", large)


def test_no_cross_joins(spark):
    for name in ("baseline_calibration", "dashboard_indicators", "choose_threshold_min_precision", "file_summary_split_keys"):
        text = plan(queries.QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_large_groups_are_cut_into_ranges(spark):
    cells = spark.range(1000).select((F.col("id") % 10 > 0).alias("k"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    text = plan(distribution.cell_quantiles(cells, ["k"], "v", {"m": 0.5}, limit=50))
    assert re.search(r"Window .*\[k#\d+, _range#\d+\], \[v#\d+ ASC", text)
