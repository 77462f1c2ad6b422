"""Weighted ranking metrics, curves and decision thresholds from scored rows.

Input is long: ``y`` (0/1), ``score``, ``weight`` and any grouping columns such as the candidate.
Rows are first reduced to one per distinct score, which also settles ties.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import attach, balanced_buckets, prefix_sums

CLIP = 1e-15


def score_table(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positive and negative weight per distinct score."""
    w, y = F.col("weight").cast("double"), F.col("y")
    return df.groupBy(*by, "score").agg(
        F.sum(F.when(y == 1, w).otherwise(0.0)).alias("pos"), F.sum(F.when(y == 0, w).otherwise(0.0)).alias("neg"))


def ranked_scores(df: DataFrame, by: Sequence[str], bounded: bool = False, hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Distinct scores with the weight at or above each: ``tp`` and ``fp``.

    ``bounded`` says that each group is small by construction (a bootstrap replicate), so one
    window per group is enough; otherwise prefix sums run over buckets of scores. ``hold`` keeps
    the table of scores, which these read several times.
    """
    table = score_table(df, by)
    if bounded:
        w = Window.partitionBy(*by).orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return table.withColumns({"tp": F.sum("pos").over(w), "fp": F.sum("neg").over(w)})
    bucketed = balanced_buckets(hold(table), by, "score")
    return prefix_sums(bucketed, by, "_b", [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, descending=True).drop("_b")


def metrics(df: DataFrame, by: Sequence[str], bounded: bool = False, hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """AUC, Gini, average precision, log-loss and Brier score per group.

    Losses carry a minus sign so that larger is better. With one class only, AUC, Gini and
    average precision are NULL.
    """
    r = ranked_scores(df, by, bounded, hold)
    p = F.greatest(F.least(F.col("score"), F.lit(1 - CLIP)), F.lit(CLIP))
    above = F.col("tp") - F.col("pos")
    s = r.groupBy(*by).agg(
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"),
        F.sum(F.col("neg") * (above + F.col("pos") / 2)).alias("_u"),
        F.sum(F.col("pos") * F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).alias("_ap"),
        F.sum(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p)).alias("_ll"),
        F.sum(F.col("pos") * (1 - F.col("score")) ** 2 + F.col("neg") * F.col("score") ** 2).alias("_br"),
    )
    both = (F.col("_P") > 0) & (F.col("_N") > 0)
    auc = F.when(both, F.try_divide(F.col("_u"), F.col("_P") * F.col("_N")))
    total = F.col("_P") + F.col("_N")
    return s.select(
        *by, auc.alias("auc"), (2 * auc - 1).alias("gini"), F.when(both, F.try_divide(F.col("_ap"), F.col("_P"))).alias("average_precision"),
        F.try_divide(F.col("_ll"), total).alias("logloss"), (-F.try_divide(F.col("_br"), total)).alias("brier"),
        total.alias("total_weight"))


def _f1(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))


def pr_curve(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Precision, recall and F1 at every distinct threshold."""
    r = ranked_scores(df, by)
    totals = r.groupBy(*by).agg(F.sum("pos").alias("_P"))
    c = attach(r, totals, by, "inner")
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("_P")), F.lit(0.0))
    return c.select(*by, F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"))


def threshold_metrics(df: DataFrame, by: Sequence[str], thresholds: DataFrame) -> DataFrame:
    """Precision, recall, F1 and predicted-positive rate at one given threshold per group.

    The thresholds, one row per group, go to the rows: a few groups would else hold all rows in as many tasks.
    """
    t = attach(df, F.broadcast(thresholds.select(*by, "threshold")), by, "inner")
    w, hit = F.col("weight").cast("double"), F.col("score") >= F.col("threshold")

    def total(c: Column) -> Column:
        return F.sum(F.when(c, w).otherwise(0.0))

    s = t.groupBy(*by).agg(
        total(hit & (F.col("y") == 1)).alias("tp"), total(hit & (F.col("y") == 0)).alias("fp"), total(~hit & (F.col("y") == 1)).alias("fn"),
        total(hit).alias("hit"), F.sum(w).alias("all"))
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return s.select(
        *by, precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"),
        F.try_divide(F.col("hit"), F.col("all")).alias("positive_rate"))


def choose_threshold(df: DataFrame, by: Sequence[str], objective: str = "max_f1", min_precision: float = 0.0, min_recall: float = 0.0) -> DataFrame:
    """Best threshold per group inside the feasible region, else with the least shortfall.

    The choice is one aggregate over an ordered record, so ties resolve the same way every time:
    shortfall, then the objective, then the other measures, then the higher threshold.
    """
    orders = {"max_precision": ("precision", "recall", "f1"), "max_f1": ("f1", "precision", "recall")}
    if objective not in orders:
        raise ValueError(f"objective: one of {sorted(orders)}")
    shortfall = F.greatest(F.lit(min_precision) - F.col("precision"), F.lit(0.0)) + F.greatest(F.lit(min_recall) - F.col("recall"), F.lit(0.0))
    rank = F.struct((-shortfall).alias("fit"), *orders[objective], "threshold")
    best = pr_curve(df, by).groupBy(*by).agg(F.max(rank).alias("b"))
    return best.select(
        *by, "b.threshold", F.col("b.precision").alias("tuning_precision"), F.col("b.recall").alias("tuning_recall"), F.col("b.f1").alias("tuning_f1"),
        (F.col("b.fit") >= 0).alias("tuning_feasible"), (-F.col("b.fit")).alias("tuning_shortfall"))


def frozen_threshold(tuning: DataFrame, evaluation: DataFrame, by: Sequence[str], **rule) -> DataFrame:
    """Choose on one split, judge unchanged on another."""
    chosen = choose_threshold(tuning, by, **rule)
    judged = threshold_metrics(evaluation, by, chosen).withColumnsRenamed({
        "precision": "evaluation_precision", "recall": "evaluation_recall", "f1": "evaluation_f1"})
    feasible = (F.col("evaluation_precision") >= rule.get("min_precision", 0.0)) & (F.col("evaluation_recall") >= rule.get("min_recall", 0.0))
    return attach(chosen, judged, by).withColumn("evaluation_feasible", feasible)


def constraint_violation(df: DataFrame, max_metric_gap: float | None, max_gini_gap: float, min_precision: float = 0.0, min_recall: float = 0.0) -> DataFrame:
    """Sum of the metric gap, the Gini gap and the threshold shortfall beyond their limits.

    Reads train_metric, valid_metric, train_gini, valid_gini, tuning_precision, tuning_recall.
    """
    zero = F.lit(0.0)
    gap = F.greatest(zero, F.col("train_metric") - F.col("valid_metric"))
    metric = F.greatest(zero, gap - max_metric_gap) if max_metric_gap is not None else zero
    gini_gap = F.abs(F.col("train_gini") - F.col("valid_gini"))
    short = F.greatest(zero, F.lit(min_precision) - F.col("tuning_precision")) + F.greatest(zero, F.lit(min_recall) - F.col("tuning_recall"))
    return df.withColumns({
        "gap": gap, "gini_gap": gini_gap,
        "constraint_violation": metric + F.greatest(zero, gini_gap - max_gini_gap) + F.coalesce(short, zero)})
