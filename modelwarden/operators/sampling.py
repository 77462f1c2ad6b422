"""Reproducible samples. Every choice follows an md5 bucket of the row key and a seed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest, unit_bucket
from ..functions.predicates import has_value
from ..sources.contract import literal_rows
from .measures import value_list
from .ordered import smallest_n
from .relate import union_named, within


def class_hash_sample(df: DataFrame, keys: Sequence[str], is_positive: Column, positive_fraction: float,
                      negative_fraction: float, seed: object, weight: str = "selection_weight") -> DataFrame:
    """Keep each class with its own probability and weight kept rows by its inverse."""
    p = F.when(F.coalesce(is_positive, F.lit(False)), F.lit(float(positive_fraction))).otherwise(F.lit(float(negative_fraction)))
    return df.withColumn("_p", p).filter(unit_bucket(keys, seed) < F.col("_p")).withColumn(
        weight, F.lit(1.0) / F.col("_p")).drop("_p")


def sample_name(stage: str, spec: Mapping[str, object]) -> str:
    """Stage name with a digest of everything that decides the content."""
    text = json.dumps(spec, sort_keys=True, default=str)
    return f"{stage}_{hashlib.sha256(text.encode()).hexdigest()[:12]}"


def staged_samples(df: DataFrame, role: str, keys: Sequence[str], is_positive: Column,
                   stages: Mapping[str, tuple[str, float, float]], seed: object) -> DataFrame:
    """All stage samples from one scan, told apart by the ``stage`` column.

    ``stages`` maps a stage to (role it is drawn from, positive fraction, negative fraction).
    The bucket is shared, so a smaller stage is contained in a larger one of the same role.
    """
    p = F.coalesce(is_positive, F.lit(False))
    options = F.array(*[
        F.struct(
            F.lit(name).alias("stage"), F.lit(source).alias("source"),
            F.when(p, F.lit(float(pos))).otherwise(F.lit(float(neg))).alias("p"),
        ) for name, (source, pos, neg) in stages.items()
    ])
    base = df.withColumn("_u", unit_bucket(keys, seed))
    drawn = base.select("*", F.inline(options)).filter((F.col("source") == F.col(role)) & (F.col("_u") < F.col("p")))
    return drawn.withColumn("selection_weight", F.lit(1.0) / F.col("p")).drop("_u", "source", "p")


def fixed_size_sample(df: DataFrame, target: str, n_rows: int, keys: Sequence[str], seed: object) -> DataFrame:
    """About ``n_rows`` rows with the class shares of the whole; exact size per class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    quota = counts.crossJoin(F.broadcast(total)).select(
        target, F.least(F.round(F.lit(float(n_rows)) * F.col("_n") / F.col("_t")).cast("long"), F.col("_n")).alias("quota"))
    tagged = df.withColumn("_h", digest(keys, seed))
    return smallest_n(tagged, [target], "_h", [F.col(k) for k in keys], quota).drop("_h")


# --- fixed values: share of each significance category that is kept ----------------
KEEP_ALL, KEEP_HALF = ("A", "B"), ("C", "D")
# -----------------------------------------------------------------------------------


def category_quota(df: DataFrame, category: Column, rounding: str = "ceil") -> DataFrame:
    """Rows available and to keep per category: all of A and B, half of C and D, none else."""
    if rounding not in ("ceil", "floor"):
        raise ValueError("rounding: ceil or floor")
    half = (F.ceil if rounding == "ceil" else F.floor)(F.col("available") / F.lit(2.0)).cast("long")
    counts = df.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("available"))
    return counts.withColumn(
        "quota",
        F.when(F.col("category").isin(*KEEP_ALL), F.col("available")).when(F.col("category").isin(*KEEP_HALF), half)
        .otherwise(F.lit(0).cast("long")))


def category_quota_sample(df: DataFrame, category: Column, keys: Sequence[str], seed: object, rounding: str = "ceil") -> DataFrame:
    """The quota rows of each category in hash order."""
    quota = category_quota(df, category, rounding).select("category", "quota")
    tagged = df.withColumns({"category": category, "_h": digest(keys, seed)}).filter(F.col("category").isin(*KEEP_ALL, *KEEP_HALF))
    return smallest_n(tagged, ["category"], "_h", [F.col(k) for k in keys], quota).drop("_h")


def quota_control(df: DataFrame, category: Column, selected: DataFrame, rounding: str = "ceil") -> DataFrame:
    """Before, selected and expected rows per category; unknown categories share one row."""
    known = ("A", "B", "C", "D", "E")
    name = F.when(F.col("category").isin(*known), F.col("category")).otherwise(F.lit("EMPTY_OR_OTHER"))
    before = category_quota(df, category, rounding).groupBy(name.alias("category")).agg(
        F.sum("available").alias("operational_count"), F.sum("quota").alias("expected_selected"))
    after = selected.groupBy("category").agg(F.count(F.lit(1)).alias("selected_count"))
    spine = literal_rows(df.sparkSession, [(c,) for c in (*known, "EMPTY_OR_OTHER")], "category string")
    return spine.join(before, "category", "left").join(after, "category", "left").fillna(0)


def case_sample(candidates: DataFrame, key: str, cases: Mapping[str, Column], per_case: int, category: str | None,
                per_category: int, n_random: int, seed: object) -> DataFrame:
    """Rows picked for each named case, for each category and at random, with merged reasons.

    A row can be picked for several reasons; reasons form a closed list, so they merge as text.
    """
    def picked(df: DataFrame, groups: Sequence[str], n: int, salt: str) -> DataFrame:
        tagged = df.withColumn("_h", digest([key], f"{seed}:{salt}"))
        quota = tagged.groupBy(*groups).agg(F.lit(n).cast("long").alias("quota"))
        return smallest_n(tagged, list(groups), "_h", [F.col(key)], quota)

    parts = [
        picked(candidates.filter(F.coalesce(cond, F.lit(False))), [], per_case, name).select(key, F.lit(name).alias("reason"))
        for name, cond in cases.items()
    ]
    if category is not None:
        chosen = picked(candidates.filter(has_value(category)), [category], per_category, "category")
        parts.append(chosen.select(key, F.concat(F.lit("SIGNIFICANCE="), F.col(category)).alias("reason")))
    parts.append(picked(candidates, [], n_random, "random").select(key, F.lit("RANDOM").alias("reason")))
    reasons = value_list(union_named(*parts), key, "reason", "sample_reason")
    return candidates.join(reasons, key)


def related_rows(tables: Mapping[str, tuple[DataFrame, str]], keys: DataFrame, key: str) -> DataFrame:
    """How many rows of each table belong to the sampled keys; use ``within`` for the rows."""
    parts = [
        within(df.withColumnRenamed(col, key), keys.select(key).distinct(), key).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows")
        for name, (df, col) in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def bernoulli_sample(df: DataFrame, keys: Sequence[str], rows: int, seed: int = 17) -> DataFrame:
    """Each row with the same chance, such that about ``rows`` of all rows stay; the rows are counted here."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    chance = F.lit(float(rows)) / F.col("_total")
    return df.crossJoin(F.broadcast(total)).filter(unit_bucket(keys, seed) < chance).drop("_total")
