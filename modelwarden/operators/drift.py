"""Population stability of features between the training part and others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import MISSING_LEVEL, unpivot
from .ordered import exact_quantiles

FLOOR = 1e-6


def _psi(expected: str, actual: str) -> Column:
    a, b = F.greatest(F.coalesce(F.col(expected), F.lit(0.0)), F.lit(FLOOR)), F.greatest(F.coalesce(F.col(actual), F.lit(0.0)), F.lit(FLOOR))
    return F.sum((b - a) * F.log(b / a))


def _shares(counts: DataFrame, roles: Sequence[str], level: str) -> DataFrame:
    """Share of each level within its feature and role, one column per role."""
    wide = counts.groupBy("feature", level).agg(*[F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)).alias(r) for r in roles])
    totals = counts.groupBy("feature").agg(*[F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)).alias(f"t_{r}") for r in roles])
    return wide.join(totals, "feature").select("feature", level, *[F.try_divide(F.col(r), F.col(f"t_{r}")).alias(r) for r in roles])


def bin_edges(long_train: DataFrame, bins: int) -> DataFrame:
    """Distinct quantile edges per feature as an array."""
    points = {f"q{i}": i / bins for i in range(bins + 1)}
    q = exact_quantiles(long_train, ["feature"], "value", points, rule="linear")
    return q.select("feature", F.array_sort(F.array_distinct(F.array(*points))).alias("edges"))


def numeric_bins(df: DataFrame, role: str, features: Sequence[str], reference: str, bins: int = 10) -> DataFrame:
    """Rows per feature, role and bin of the reference quantiles; NULL values left out."""
    long = unpivot(df, [F.col(role).alias("role")], features, "double").filter(
        F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != F.lit(float("inf"))))
    edges = bin_edges(long.filter(F.col("role") == reference), bins).filter(F.size("edges") >= 3)
    inner = F.slice(F.col("edges"), F.lit(2), F.size("edges") - 2)
    placed = long.join(F.broadcast(edges), "feature").withColumn(  # one row per feature
        "bin", F.aggregate(inner, F.lit(0), lambda acc, e: acc + F.when(e < F.col("value"), 1).otherwise(0)))
    return placed.groupBy("feature", "role", "bin").agg(F.count(F.lit(1)).alias("n"))


def psi_numeric(df: DataFrame, role: str, features: Sequence[str], reference: str, others: Sequence[str], bins: int = 10) -> DataFrame:
    """PSI per numeric feature against each other role; 0 where the reference has too few edges."""
    shares = _shares(numeric_bins(df, role, features, reference, bins), [reference, *others], "bin")
    found = shares.groupBy("feature").agg(*[_psi(reference, o).alias(f"psi_{o}") for o in others])
    return _all_features(df, features, found, others)


def psi_categorical(df: DataFrame, role: str, features: Sequence[str], reference: str, others: Sequence[str]) -> DataFrame:
    """PSI per categorical feature over the union of levels; a missing value is a level."""
    long = unpivot(df, [F.col(role).alias("role")], features, "string").withColumn("value", F.coalesce("value", F.lit(MISSING_LEVEL)))
    counts = long.filter(F.col("role").isin(reference, *others)).groupBy("feature", "role", "value").agg(F.count(F.lit(1)).alias("n"))
    shares = _shares(counts, [reference, *others], "value")
    found = shares.groupBy("feature").agg(*[_psi(reference, o).alias(f"psi_{o}") for o in others])
    return _all_features(df, features, found, others)


def _all_features(df: DataFrame, features: Sequence[str], found: DataFrame, others: Sequence[str]) -> DataFrame:
    names = df.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    return names.join(found, "feature", "left").fillna(0.0, [f"psi_{o}" for o in others])


def missing_rates(df: DataFrame, role: str, features: Sequence[str], reference: str, roles: Sequence[str]) -> DataFrame:
    """Missing share per feature and role, and distinct values on the reference."""
    by_role = {r: F.col(role) == r for r in roles}
    aggs = []
    for i, c in enumerate(features):
        aggs += [
            F.try_divide(F.sum(F.when(cond, F.col(c).isNull().cast("long"))), F.sum(cond.cast("long"))).alias(f"m{i}_{r}")
            for r, cond in by_role.items()
        ]
    rates = df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"m{i}_{r}").alias(f"missing_{r}") for r in roles]) for i, c in enumerate(features)])))
    values = unpivot(df.filter(F.col(role) == reference), [], features, "string").filter("value is not null")
    distinct = values.groupBy("feature").agg(F.countDistinct("value").alias("reference_values"))
    return rates.join(distinct, "feature", "left").fillna(0, ["reference_values"])


def drift_report(df: DataFrame, role: str, numeric: Sequence[str], categorical: Sequence[str], reference: str, others: Sequence[str]) -> DataFrame:
    """PSI against each role, missing rates and distinct values per feature."""
    psi = psi_numeric(df, role, numeric, reference, others).unionByName(psi_categorical(df, role, categorical, reference, others))
    return psi.join(missing_rates(df, role, [*numeric, *categorical], reference, [reference, *others]), "feature")
