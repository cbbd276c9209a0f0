"""Classifier evaluation: confusion counts, curves, areas and the choice of a threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.rules import record_label, share
from packetloom.operators.distribution import ROWS_PER_TASK, running_totals

EPSILON = 1e-12  # fixed value: keeps the F scores defined where precision and recall are 0


def confusion(df: DataFrame, label: str, probability: str, threshold: float) -> DataFrame:
    """One row with tn, fp, fn, tp."""
    predicted = record_label(F.col(probability), threshold)
    actual = F.col(label)
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return df.agg(*[F.count_if((actual == a) & (predicted == p)).alias(n) for n, (a, p) in cells.items()])


def rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision and recall to confusion counts, 0.0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        "tn",
        "fp",
        "fn",
        "tp",
        share(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and their macro and weighted means, from confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(name: str, hit: Column, predicted: Column, actual: Column) -> Column:
        precision, recall = share(hit, predicted), share(hit, actual)
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            share(2 * precision * recall, precision + recall).alias("f1"),
            actual.alias("support"),
        )

    both = counts.select(line("Normal", tn, tn + fn, tn + fp).alias("a"), line("Attack", tp, tp + fp, tp + fn).alias("b"))
    support = F.col("a.support") + F.col("b.support")

    def mean(name: str, weight_a: Column, weight_b: Column) -> Column:
        values = [(F.col(f"a.{m}") * weight_a + F.col(f"b.{m}") * weight_b).alias(m) for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *values, support.alias("support"))

    half = F.lit(0.5)
    lines = F.array(
        F.col("a"),
        F.col("b"),
        mean("macro avg", half, half),
        mean("weighted avg", share(F.col("a.support"), support), share(F.col("b.support"), support)),
    )
    return both.select(F.inline(lines))


def score_curve(
    df: DataFrame, label: str, probability: str, *, limit: int = ROWS_PER_TASK
) -> DataFrame:
    """One row per distinct score, highest first in the totals: pos, neg, cum_pos (TP), cum_neg (FP).

    Equal scores collapse before any ordering, so ties count as one point.
    """
    rows = df.count()
    cells = df.groupBy(F.col(probability).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(cells, "score", ["pos", "neg"], descending=True, rows=rows, limit=limit)


def _totals(curve: DataFrame) -> tuple[Column, Column]:
    ends = curve.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return ends.select("p").scalar(), ends.select("n").scalar()


def ranking_areas(curve: DataFrame) -> DataFrame:
    """One row: roc_auc (ties count half) and pr_auc (average precision as a step sum)."""
    positives, negatives = F.sum("pos"), F.sum("neg")
    # Negatives at a score rank below all positives above it and tie with those at it.
    concordant = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return curve.agg(
        (concordant / F.nullif(positives * negatives, F.lit(0))).alias("roc_auc"),
        (steps / F.nullif(positives, F.lit(0))).alias("pr_auc"),
    )


def precision_recall(curve: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score used as threshold."""
    positives, _ = _totals(curve)
    return curve.select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        share(F.col("cum_pos"), positives).alias("recall"),
    )


def choose_threshold(
    curve: DataFrame, strategy: str, *, fixed_threshold: float = 0.5, min_precision: float = 0.0
) -> DataFrame:
    """One row: threshold and its precision, recall and score.

    'f1' and 'f2' take the best F score, at the lowest threshold on ties, among
    the thresholds that reach ``min_precision`` if any does.
    """
    if strategy == "fixed":
        return curve.sparkSession.range(1).select(F.lit(fixed_threshold).alias("threshold"))
    weight = {"f1": 1.0, "f2": 4.0}.get(strategy)
    if weight is None:
        raise ValueError(f"unknown threshold strategy: {strategy}")
    points = precision_recall(curve)
    p, r = F.col("precision"), F.col("recall")
    scored = points.withColumn("score", (1 + weight) * p * r / (weight * p + r + EPSILON))
    allowed = p >= F.lit(min_precision)
    if min_precision > 0:
        any_allowed = points.agg(F.coalesce(F.bool_or(allowed), F.lit(False)).alias("a")).scalar()
        scored = scored.where(allowed | ~any_allowed)
    best = F.struct(F.col("score"), -F.col("threshold"))
    return scored.agg(F.max_by(F.struct("threshold", "precision", "recall", "score"), best).alias("b")).select(
        F.col("b.threshold").alias("threshold"),
        F.col("b.precision").alias("validation_precision"),
        F.col("b.recall").alias("validation_recall"),
        F.col("b.score").alias("validation_score"),
    )


def evaluate(
    df: DataFrame, label: str, probability: str, threshold: float, *, limit: int = ROWS_PER_TASK
) -> dict[str, float]:
    """All holdout metrics as numbers."""
    counts = rates(confusion(df, label, probability, threshold)).first().asDict()
    areas = ranking_areas(score_curve(df, label, probability, limit=limit)).first().asDict()
    return {**counts, **areas}
