"""Fits use few tasks, screened trials are held."""

from pyspark.sql import functions as F


def test_fits_use_few_tasks_and_screened_trials_are_held(spark):
    from modelwarden.operators import subsets_ml as ml

    rows = spark.range(400, numPartitions=64).select(
        (F.col("id") % 7).cast("double").alias("a"), ((F.col("id") * 13) % 11).cast("double").alias("b"), (F.col("id") * 31 % 17 > 8).cast("int").alias("y"), F.lit(1.0).alias("w"))
    seen = []

    class Counting:
        def __init__(self, *args):
            self.inner = ml.logistic(*args)

        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return self.inner.fit(df)

    scores = ml.score_subsets(rows, rows, {"c": ("a", "b")}, "y", "w", classifier=Counting)
    assert scores.count() == 1 and max(seen) <= 2 * spark.sparkContext.defaultParallelism < 64
    held = []
    ml.halving_round(ml.as_trials(scores), lambda c: held.append(dict(c)) or scores, "fixed", 1.0, 1, lambda d: held.append(len(held)) or d.localCheckpoint())
    assert held[-1] == {"c": ["a", "b"]} and len(held) > 4  # the screen itself, before the layers of the selection
