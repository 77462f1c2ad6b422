"""Counts, rates, durations, pivots and top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import ALL_DIM, NULL_DIM, as_col, blank
from .ordered import balanced_buckets, exact_quantiles, following, running, smallest_n, spread_attach

Indicator = tuple[str, Column, Column]


def _dims(d1: Column, d2: Column | None) -> list[Column]:
    return [
        F.coalesce(d1.cast("string"), F.lit(NULL_DIM)).alias("dim_1_value"),
        (F.lit(ALL_DIM) if d2 is None else F.coalesce(d2.cast("string"), F.lit(ALL_DIM))).alias("dim_2_value"),
    ]


def _rate(num: str = "numerator", den: str = "denominator") -> Column:
    return F.try_divide(F.lit(100.0) * F.col(num), F.col(den))


def dist(df: DataFrame, d1: Column, d2: Column | None = None) -> DataFrame:
    """Rows per pair of dimension values."""
    return df.select(*_dims(d1, d2)).groupBy("dim_1_value", "dim_2_value").agg(
        F.count(F.lit(1)).alias("numerator")
    ).select(
        "dim_1_value", "dim_2_value", F.col("numerator").cast("double").alias("metric_value"),
        "numerator", F.lit(None).cast("long").alias("denominator"),
    )


def gap(df: DataFrame, condition: Column, d1: Column, d2: Column | None = None) -> DataFrame:
    """Share of rows meeting a condition, with numerator and denominator."""
    return df.select(*_dims(d1, d2), condition.cast("long").alias("_bad")).groupBy(
        "dim_1_value", "dim_2_value"
    ).agg(
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("numerator"), F.count(F.lit(1)).alias("denominator")
    ).select("dim_1_value", "dim_2_value", _rate().alias("metric_value"), "numerator", "denominator")


def indicator_gaps(df: DataFrame, indicators: Sequence[Indicator], d2: Column | None) -> DataFrame:
    """Several gap rates over one scan; each indicator brings its own scope.

    An indicator is ``(name, applies, bad)``. Rows are expanded in place and combined before
    the shuffle, so the cost is one pass whatever the number of indicators.
    """
    rows = F.array(*[
        F.struct(F.lit(n).alias("name"), a.alias("applies"), b.cast("long").alias("bad")) for n, a, b in indicators
    ])
    second = F.lit(ALL_DIM) if d2 is None else F.coalesce(d2.cast("string"), F.lit(ALL_DIM))
    long = df.select(second.alias("dim_2_value"), F.inline(rows))
    return long.filter("applies").groupBy(F.col("name").alias("dim_1_value"), "dim_2_value").agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("numerator"), F.count(F.lit(1)).alias("denominator")
    ).select("dim_1_value", "dim_2_value", _rate().alias("metric_value"), "numerator", "denominator")


def duration_quantiles(df: DataFrame, group: Column, days: Column, fractions: Mapping[str, float]) -> DataFrame:
    """Exact duration quantiles per group in the shape of a portfolio result."""
    base = df.select(group.alias("dim_1_value"), days.alias("days")).filter("days >= 0")
    q = exact_quantiles(base, ["dim_1_value"], "days", fractions)
    pairs = F.array(*[
        F.struct(F.lit(n).alias("dim_2_value"), F.col(n).cast("double").alias("metric_value")) for n in fractions
    ])
    return q.select("dim_1_value", "n", F.inline(pairs)).select(
        "dim_1_value", "dim_2_value", "metric_value", F.lit(None).cast("long").alias("numerator"),
        F.col("n").alias("denominator"),
    )


def approx_duration_quantiles(df: DataFrame, group: Column, days: Column, fraction: float, accuracy: int = 10000) -> DataFrame:
    return df.select(group.alias("dim_1_value"), days.alias("days")).filter("days >= 0").groupBy("dim_1_value").agg(
        F.percentile_approx("days", fraction, accuracy).alias("metric_value"), F.count("days").alias("denominator")
    )


def above_group_quantile(df: DataFrame, group: str, value: str, fraction: float, min_rows: int) -> DataFrame:
    """Rows of groups that are large enough, with the group quantile and an ``above`` flag."""
    base = df.filter(F.col(value) >= 0)
    q = exact_quantiles(base, [group], value, {"limit": fraction}).filter(F.col("n") >= min_rows)
    return spread_attach(base, q.withColumn("_rows", F.col("n")), [group], "inner", rows="_rows").withColumn("above", F.col(value) > F.col("limit"))


def any_by(df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(F.when(condition, 1).otherwise(0)).alias(name))


def value_list(df: DataFrame, key: str, value: str, name: str, sep: str = " | ") -> DataFrame:
    """Sorted distinct values per key as one text. For closed value sets such as statuses."""
    pairs = df.select(key, F.col(value).cast("string").alias("_v")).filter("_v is not null").distinct()
    return pairs.groupBy(key).agg(F.concat_ws(sep, F.sort_array(F.collect_list("_v"))).alias(name))


def violation_matrix(detail: DataFrame, entity: str, control: str, ids: Sequence[int]) -> DataFrame:
    """One row per entity, one 0/1 column per control."""
    cols = [
        F.max(F.when(F.col(control) == i, 1).otherwise(0)).alias(f"check_{i:02d}") for i in ids
    ]
    return detail.groupBy(entity).agg(*cols)


def share_of_total(df: DataFrame, count: str, name: str = "share_pct", digits: int = 2) -> DataFrame:
    """Percent of the column total; the total is one row, joined back."""
    total = df.agg(F.sum(count).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(
        name, F.round(F.try_divide(F.lit(100.0) * F.col(count), F.col("_total")), digits)
    ).drop("_total")


def flag_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Row count and one conditional count per flag in a single pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in flags.items()],
    )


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and blank counts per column, one aggregate for the whole table."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}"))
        aggs.append(F.sum(blank(c).cast("long")).alias(f"b{i}"))
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"), F.col(f"b{i}").alias("blank_count"))
        for i, c in enumerate(columns)
    ])
    return df.agg(*aggs).select("rows", F.inline(pairs)).select(
        "column_name", "null_count", "blank_count",
        F.round(F.try_divide(F.lit(100.0) * F.col("blank_count"), F.col("rows")), 2).alias("blank_pct"),
    )


def orphan_rate(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, relation: str,
                skip_null: bool = False) -> DataFrame:
    """Child rows without a parent. Child keys are counted before the join."""
    c = child.filter(F.col(child_key).isNotNull()) if skip_null else child
    counts = c.groupBy(F.col(child_key).cast("string").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(parent_key).cast("string").alias("_k")).dropna().distinct().withColumn("_hit", F.lit(1))
    return counts.join(keys, "_k", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n")).otherwise(0)), F.lit(0)).alias("numerator"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("denominator"),
    ).select(
        F.lit(relation).alias("dim_1_value"), F.lit(ALL_DIM).alias("dim_2_value"),
        _rate().alias("metric_value"), "numerator", "denominator",
    )


def entity_features(df: DataFrame, entity: str, amount: str, category: str) -> DataFrame:
    """Sum, mean, count, distinct count and maximum per entity, joined back to each row."""
    agg = df.groupBy(entity).agg(
        F.sum(amount).alias("amount_sum"), F.avg(amount).alias("amount_mean"),
        F.count(F.lit(1)).alias("row_count"), F.countDistinct(category).alias("category_count"),
        F.max(amount).alias("amount_max"),
    )
    return spread_attach(df, agg.filter(F.col(entity).isNotNull()).withColumn("_rows", F.col("row_count")), [entity], rows="_rows")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per group; the limit also applies inside each task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def seeded_limit(df: DataFrame, digest: Column, order: Sequence[str], n: int) -> DataFrame:
    """``n`` rows in hash order: repeatable, unlike ordering by rand."""
    tagged = df.withColumn("_h", digest)
    return tagged.orderBy("_h", *order).limit(n).drop("_h")


def running_plateau(df: DataFrame, key: str, step: str, value: str, delta: float, patience: int) -> DataFrame:
    """Best value so far and whether each of the last ``patience`` gains stayed below ``delta``.

    A search may have any number of steps (``step`` is a number, one row each): both scans run over buckets
    of steps. The gains stay small as long as the last step without a known small gain lies far enough back.
    """
    buckets = balanced_buckets(df, [key], step)
    scanned = running(buckets, [key], "_b", [F.col(step)], {"best": ("max", F.col(value)), "_rank": ("sum", F.lit(1).cast("long"))})
    gains = following(scanned.withColumn("_up", -F.col("_b")), [key], "_up", [F.col(step).desc()], "best", "_before").drop("_up")
    gains = gains.withColumn("gain", F.col("best") - F.col("_before"))
    jump = F.when(F.coalesce(F.col("gain") >= delta, F.lit(True)), F.col("_rank"))
    last = running(gains, [key], "_b", [F.col(step)], {"_jump": ("max", jump)})
    return last.withColumn("plateau", F.col("_rank") - F.col("_jump") >= patience).select(*df.columns, "best", "gain", "plateau")
