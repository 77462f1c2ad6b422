"""Scoring of feature subsets with Spark ML classifiers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..sources.contract import literal_rows
from .evaluate import metrics
from .trials import nsga_select, promotion_size, with_key


def logistic(seed: int, label: str, weight: str):
    return LogisticRegression(featuresCol="_x", labelCol=label, weightCol=weight, maxIter=20)


def boosted(seed: int, label: str, weight: str):
    return GBTClassifier(featuresCol="_x", labelCol=label, weightCol=weight, maxIter=10, maxDepth=3, seed=seed)


def _scored(model, df: DataFrame, label: str, weight: str, candidate: str, seed: int, part: str) -> DataFrame:
    return model.transform(df).select(
        F.lit(candidate).alias("candidate"), F.lit(seed).alias("seed"), F.lit(part).alias("part"), F.col(label).cast("int").alias("y"),
        F.col(weight).cast("double").alias("weight"), vector_to_array("probability")[1].alias("score"))


def score_subsets(train: DataFrame, valid: DataFrame, candidates: Mapping[str, Sequence[str]], label: str, weight: str,
                  seeds: Sequence[int] = (1,), classifier: Callable = logistic, metric: str = "gini") -> DataFrame:
    """Fit every candidate subset with every seed; metric on both parts, gap and spread.

    Each fit is a distributed job over the training part. Every step of a fit sends a result from each task to the
    driver, so the training rows are held in a few tasks a core, however many files or shuffle parts they come in.
    All predictions are judged in one aggregate at the end.
    """
    parts, tasks = [], 2 * train.sparkSession.sparkContext.defaultParallelism
    for name, features in candidates.items():
        assembler = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep")
        tr, va = assembler.transform(train), assembler.transform(valid)
        for seed in seeds:
            model = classifier(seed, label, weight).fit(tr.coalesce(tasks))
            parts += [_scored(model, tr, label, weight, name, seed, "train"), _scored(model, va, label, weight, name, seed, "valid")]
    scores = metrics(reduce(lambda a, b: a.unionByName(b), parts), ["candidate", "seed", "part"])
    on = {p: F.when(F.col("part") == p, F.col(metric)) for p in ("train", "valid")}
    out = scores.groupBy("candidate").agg(
        F.avg(on["train"]).alias("train_metric"), F.avg(on["valid"]).alias("valid_metric"), F.coalesce(F.stddev_samp(on["valid"]), F.lit(0.0)).alias("metric_std"))
    names = literal_rows(train.sparkSession, [(n, "|".join(sorted(f)), len(set(f))) for n, f in candidates.items()],
                         "candidate string,subset_key string,n_features int")
    return names.join(out, "candidate").withColumn("gap", F.greatest(F.lit(0.0), F.col("train_metric") - F.col("valid_metric")))


def screening_pool(train: DataFrame, features: Sequence[str], label: str, weight: str, top_n: int, random_n: int, seed: int = 7) -> DataFrame:
    """Features by forest importance: the best ``top_n`` and a random few of the rest.

    One row per feature, so the ordering is over a short list.
    """
    x = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(train)
    forest = RandomForestClassifier(featuresCol="_x", labelCol=label, weightCol=weight, numTrees=20, maxDepth=4, seed=seed).fit(x)
    rows = [(f, float(forest.featureImportances[i])) for i, f in enumerate(features)]
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
    named = literal_rows(train.sparkSession, [(f, imp, i + 1) for i, (f, imp) in enumerate(ranked)], "feature string,importance double,rank int")
    rest = named.filter(F.col("rank") > top_n).orderBy(digest(["feature"], seed)).limit(random_n).select("feature", F.lit(1).alias("_explore"))
    source = F.when(F.col("rank") <= top_n, "top_importance").when(F.col("_explore") == 1, "random_exploration").otherwise("outside_pool")
    return named.join(rest, "feature", "left").select("feature", "importance", "rank", source.alias("source"))


def halving_round(screen: DataFrame, confirm: Callable[[Mapping[str, Sequence[str]]], DataFrame], strategy: str, fraction: float,
                  min_promoted: int, hold: Callable[[DataFrame], DataFrame], **limits) -> DataFrame:
    """Screened trials, promotion of the best trade-offs, then a full-size score of those.

    The screened trials, one row each, are held: promotion and selection read them many times.
    """
    screen = hold(screen)
    promoted = promotion_size(screen, strategy, fraction, min_promoted, **limits).first()["promoted"]
    chosen = nsga_select(screen, int(promoted), hold).select("trial_id", "features").collect()  # a handful of promoted subsets
    return confirm({str(r.trial_id): list(r.features) for r in chosen})


def as_trials(scores: DataFrame) -> DataFrame:
    """Scored subsets in the shape of trials."""
    return with_key(scores.select(
        F.col("candidate").alias("trial_id"), F.split("subset_key", r"\|").alias("features"), "valid_metric", "metric_std",
        F.lit(0.0).alias("constraint_violation"), F.lit("screen").alias("fidelity"), F.lit("ml").alias("method")))
