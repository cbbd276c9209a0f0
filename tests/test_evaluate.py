import pytest
from pyspark.sql import functions as F

from packetloom.operators.evaluate import (
    choose_threshold,
    class_report,
    confusion,
    evaluate,
    precision_recall,
    ranking_areas,
    rates,
    score_curve,
)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.4, 1), (0.2, 0)], "p double, y int")


def test_published_confusion(spark):
    counts = spark.createDataFrame([(4600, 260, 1398, 25140)], "tn bigint, fp bigint, fn bigint, tp bigint")
    row = rates(counts).first()
    assert (round(row.accuracy, 4), round(row.precision, 2), round(row.recall, 2)) == (0.9472, 0.99, 0.95)
    lines = {r["class"]: r for r in class_report(counts).collect()}
    assert (round(lines["Normal"].precision, 2), round(lines["Normal"].recall, 2)) == (0.77, 0.95)
    assert lines["weighted avg"].support == 31398


def test_areas_and_ties(sample):
    row = ranking_areas(score_curve(sample, "y", "p")).first()
    assert row.pr_auc == pytest.approx(0.7) and row.roc_auc == pytest.approx(0.6111, abs=1e-4)


def test_curve_has_one_row_per_score(sample):
    rows = {r.threshold: (r.precision, r.recall) for r in precision_recall(score_curve(sample, "y", "p")).collect()}
    assert len(rows) == 5 and rows[0.7] == pytest.approx((0.5, 2 / 3))


def test_threshold_choice(spark, sample):
    curve = score_curve(sample, "y", "p")
    assert choose_threshold(curve, "fixed", fixed_threshold=0.5).first().threshold == 0.5
    # F1 ties between 0.4 (0.75) and others are decided by score first, then the lower threshold.
    assert choose_threshold(curve, "f1").first().threshold == 0.4
    assert choose_threshold(curve, "f2").first().threshold == 0.4
    assert choose_threshold(curve, "f1", min_precision=0.9).first().threshold == 0.9
    # No threshold reaches that precision on a sample whose best score is a false alarm: the floor is ignored.
    wrong = spark.createDataFrame([(0.9, 0), (0.5, 1)], "p double, y int")
    assert choose_threshold(score_curve(wrong, "y", "p"), "f1", min_precision=0.9).first().threshold == 0.5
    tie = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 0), (0.7, 1), (0.6, 1)], "p double, y int")
    assert choose_threshold(score_curve(tie, "y", "p"), "f1").first().threshold == 0.6
    with pytest.raises(ValueError):
        choose_threshold(curve, "best")


def test_empty_denominators(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, y int")
    row = rates(confusion(df, "y", "p", 0.5)).first()
    assert (row.precision, row.recall, row.accuracy) == (0.0, 0.0, 1.0)
    assert ranking_areas(score_curve(df, "y", "p")).first().roc_auc is None


def test_split_curve_equals_small(spark):
    df = spark.range(4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("p"), F.pmod(F.hash("id"), F.lit(3)).cast("int").alias("z")
    ).select("p", (F.col("z") == 0).cast("int").alias("y"))
    a = evaluate(df, "y", "p", 0.5)
    b = evaluate(df, "y", "p", 0.5, limit=100)
    assert a == pytest.approx(b)
