"""Exact ranks, prefix sums and quantiles without a window over a whole group.

A group may hold most of the rows, so no operator here sorts a group in one task. Each group
is cut into buckets that follow the wanted order; totals per bucket are cumulated over the
small bucket table, and a window only ever covers one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _match(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def attach(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join columns of ``side`` by null-safe keys; without keys ``side`` has a single row."""
    extra = [c for c in side.columns if c not in keys]
    if not keys:
        return df.crossJoin(F.broadcast(side.select(*extra)))
    return df.alias("l").join(side.alias("r"), _match("l", "r", keys), how).select(
        "l.*", *[F.col(f"r.{c}") for c in extra]
    )


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: str, share: float) -> DataFrame:
    """One row with a map: keys that hold more than ``share`` of all rows, and into how many parts
    each has to be cut so that no part holds more. At most ``1 / share`` entries."""
    total = counts.agg((F.sum(rows) * share).alias("_part"))
    large = counts.crossJoin(F.broadcast(total)).filter(F.col(rows) > F.col("_part"))
    return large.agg(F.map_from_entries(F.collect_list(F.struct(_key_of(keys), F.ceil(F.col(rows) / F.col("_part")).cast("int")))).alias("_hot"))


def _key_of(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))


def spread_attach(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left", rows: str | None = None, share: float = 0.01) -> DataFrame:
    """Like :func:`attach`, but rows of a hot key are dealt to several tasks and its side rows repeated.

    How many rows a key has comes from column ``rows`` of ``side`` (then left out of the result) or,
    without one, from an aggregate of ``df``. The part of a row follows from its own values, so a
    repeated task deals it alike. ``side`` has one row per key or few.
    """
    counts = side.select(*keys, F.col(rows).alias("_rows")) if rows else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = hot_keys(counts, keys, "_rows", share)
    side = side.drop(rows) if rows else side
    parts = F.coalesce(F.try_element_at("_hot", _key_of(keys)), F.lit(1))
    dealt = df.crossJoin(F.broadcast(hot)).withColumn("_part", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), parts)).drop("_hot")
    repeated = side.crossJoin(F.broadcast(hot)).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).drop("_hot")
    return attach(dealt, repeated, [*keys, "_part"], how).drop("_part")


def balanced_buckets(df: DataFrame, keys: Sequence[str], value: str, name: str = "_b",
                     side: int = 16) -> DataFrame:
    """Add a bucket number that grows with ``value`` and cuts each group into like-sized parts.

    The ``side * side`` edges are approximate quantiles, a sketch of fixed size per group;
    exactness of what is computed on top does not depend on them. A value finds its bucket in
    two short steps: among every ``side``-th edge, then among the edges between two of those.
    """
    total = side * side
    points = [i / total for i in range(1, total)]
    edges = df.groupBy(*keys).agg(F.percentile_approx(value, points, 10 * total).alias("_edges"))
    edges = edges.withColumn("_coarse", F.array(*[F.col("_edges")[side * j - 1] for j in range(1, side)]))

    def below(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda acc, e: acc + F.when(e < F.col(value), 1).otherwise(0))

    placed = attach(df, edges, keys).withColumn("_c", below(F.col("_coarse")))
    fine = F.slice(F.col("_edges"), F.col("_c") * side + 1, side - 1)
    return placed.withColumn(name, F.col("_c") * side + below(fine)).drop("_edges", "_coarse", "_c")


def prefix_sums(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column],
                sums: Mapping[str, str | Column], descending: bool = False) -> DataFrame:
    """Inclusive running sums over each group in the order of ``bucket`` then ``order``."""
    totals = df.groupBy(*keys, bucket).agg(
        *[F.sum(c if isinstance(c, Column) else F.col(c)).alias(f"_t_{n}") for n, c in sums.items()]
    )
    ordering = F.col(bucket).desc() if descending else F.col(bucket).asc()
    before = Window.partitionBy(*keys).orderBy(ordering).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, bucket,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = df.withColumns(
        {f"_s_{n}": F.sum(c if isinstance(c, Column) else F.col(c)).over(inside) for n, c in sums.items()}
    )
    joined = attach(local, offsets, [*keys, bucket], "inner")
    return joined.withColumns({n: F.col(f"_s_{n}") + F.col(f"_o_{n}") for n in sums}).drop(
        *[f"_s_{n}" for n in sums], *[f"_o_{n}" for n in sums]
    )


def running(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], values: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Running aggregates over each group in the order of ``bucket`` then ``order``, current row included.

    ``values``: name to (step, column); a step is any that combines in order: ``sum``, ``max``, ``min``,
    ``last`` (the last known value). A window covers one bucket; over buckets only their totals are scanned.
    """
    steps = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}
    join = {
        "sum": lambda x, y: F.coalesce(x + y, x, y), "max": lambda x, y: F.greatest(x, y), "min": lambda x, y: F.least(x, y),
        "last": lambda x, y: F.coalesce(y, x)}
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns({f"_s_{n}": steps[step](c).over(inside) for n, (step, c) in values.items()})
    spot = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order))
    tails = local.withColumn("_d", spot).groupBy(*keys, bucket).agg(*[F.max_by(f"_s_{n}", "_d").alias(f"_t_{n}") for n in values])
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*keys, bucket, *[steps[step](F.col(f"_t_{n}")).over(before).alias(f"_o_{n}") for n, (step, _) in values.items()])
    joined = attach(local, carried, [*keys, bucket], "inner")
    return joined.withColumns({n: join[step](F.col(f"_o_{n}"), F.col(f"_s_{n}")) for n, (step, _) in values.items()}).drop(
        *[f"_s_{n}" for n in values], *[f"_o_{n}" for n in values])


def following(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``value`` of the next row of the group; the last row of a bucket takes the first of the next one that has rows."""
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    local = df.withColumns({"_next": F.lead(value).over(inside), "_r": F.row_number().over(inside)})
    sizes = local.groupBy(*keys, bucket).agg(F.max(F.when(F.col("_r") == 1, F.col(value))).alias("_first"), F.max("_r").alias("_rows"))
    heads = sizes.select(*keys, bucket, "_rows", F.lead("_first").over(Window.partitionBy(*keys).orderBy(bucket)).alias("_head"))
    joined = attach(local, heads, [*keys, bucket], "inner")
    return joined.withColumn(name, F.when(F.col("_r") == F.col("_rows"), F.col("_head")).otherwise(F.col("_next"))).drop("_next", "_r", "_rows", "_head")


def bucketed_row_number(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column],
                        name: str = "rank") -> DataFrame:
    """Exact row number over a group; ``bucket`` must grow with ``order``."""
    return prefix_sums(df, keys, bucket, order, {name: F.lit(1).cast("long")})


def smallest_n(df: DataFrame, keys: Sequence[str], hex_digest: str, order: Sequence[Column],
               quota: DataFrame, quota_col: str = "quota") -> DataFrame:
    """The ``quota`` rows of each group with the smallest digests.

    Only rows in the one boundary bucket of a group are ranked; all rows in lower buckets are
    kept and all rows in higher ones dropped by comparing bucket numbers.
    """
    digits = 4
    b = df.withColumn("_b", F.substring(hex_digest, 1, digits))
    hist = attach(b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n")), quota, keys, "inner")
    upto = Window.partitionBy(*keys).orderBy("_b")
    cum = hist.withColumn("_cum", F.sum("_n").over(upto))
    fate = cum.select(
        *keys, "_b", (F.col("_cum") <= F.col(quota_col)).alias("_whole"),
        (F.col(quota_col) - (F.col("_cum") - F.col("_n"))).alias("_take"),
    ).filter("_whole or _take > 0")
    marked = attach(b, fate, [*keys, "_b"], "inner")
    edge = Window.partitionBy(*keys, "_b").orderBy(hex_digest, *order)
    part = marked.filter("not _whole").withColumn("_r", F.row_number().over(edge)).filter("_r <= _take")
    return marked.filter("_whole").unionByName(part.drop("_r")).drop("_b", "_take", "_whole")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float],
                    rule: str = "disc", accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles of each group as one row per group, NULL values left out.

    ``rule``: ``disc`` takes the first value whose cumulative share reaches the fraction,
    ``nearest`` the value at rank ``floor(q * (n - 1) + 0.5)``, ``linear`` interpolates.
    Adds ``n``, the number of values.

    The input is read twice. The first pass is a mergeable sketch whose rank error is at most
    ``1 / accuracy`` of the group, so two of its values enclose each wanted rank. The second pass
    counts what lies below and above these and keeps apart only the distinct values between,
    about ``4 / accuracy`` of the group; they alone are ranked.
    """
    if rule not in ("disc", "nearest", "linear"):
        raise ValueError(f"unknown quantile rule {rule!r}")
    names, slack = list(fractions), 2.0 / accuracy
    points = [min(max(q + side * slack, 0.0), 1.0) for q in fractions.values() for side in (-1, 1)]
    present = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    sketch = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", points, accuracy).alias("_e"))
    placed = spread_attach(present, sketch.withColumn("_rows", F.col("_total")), keys, "inner", rows="_rows") if keys else attach(present, sketch, keys, "inner")
    side = [F.when(F.col("_v") < F.col("_e")[2 * i], -1).when(F.col("_v") > F.col("_e")[2 * i + 1], 1).otherwise(0) for i in range(len(names))]
    spots = F.array(*[F.struct(F.lit(i).alias("_i"), s.alias("_s"), F.when(s == 0, F.col("_v")).alias("_in")) for i, s in enumerate(side)])
    cells = placed.select(*keys, "_total", "_v", F.inline(spots)).groupBy(*keys, "_total", "_i", "_s", "_in").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    up = Window.partitionBy(*keys, "_i").orderBy("_s", "_in").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cells.withColumn("_cum", F.sum("_n").over(up))
    total, before = F.col("_total"), F.col("_cum") - F.col("_n")

    def at(i: int, rank: Column) -> Column:
        # rounding may put a rank one past the enclosed values: the last one below or the first one above
        hit = (F.col("_i") == i) & (rank > before) & (rank <= F.col("_cum"))
        found = F.when((F.col("_s") <= 0) & (rank == F.col("_cum")), F.col("_high")).when((F.col("_s") == 0) | (rank == before + 1), F.col("_low"))
        return F.max(F.when(hit, F.coalesce(found, F.raise_error(F.lit("the sketch does not enclose the rank")))))

    aggs = []
    for i, (name, q) in enumerate(fractions.items()):
        if rule == "disc":
            aggs.append(at(i, F.greatest(F.ceil(F.lit(q) * total - F.lit(1e-9)), F.lit(1))).alias(name))
        elif rule == "nearest":
            aggs.append(at(i, F.floor(F.lit(q) * (total - 1) + F.lit(0.5)) + 1).alias(name))
        else:
            pos = F.lit(q) * (total - 1)
            low = F.floor(pos + F.lit(1e-12)) + 1
            high = F.least(low + 1, total)
            frac = F.max(pos - (low - 1))
            first, second = at(i, low).cast("double"), at(i, high).cast("double")
            aggs.append((first + (second - first) * F.greatest(frac, F.lit(0.0))).alias(name))
    return ranked.groupBy(*keys).agg(*aggs, F.max("_total").alias("n"))


def bucketed_lags(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str) -> DataFrame:
    """``lag1`` and ``lag2`` of a value in group order; a window covers one bucket only.

    Each bucket hands its last two values to the next non-empty bucket of the group.
    """
    asc = Window.partitionBy(*keys, bucket).orderBy(*order)
    desc = Window.partitionBy(*keys, bucket).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        df.select(*keys, bucket, *[c for c in order if c not in keys], value)
        .withColumn("_d", F.row_number().over(desc)).filter("_d <= 2")
        .groupBy(*keys, bucket).agg(
            F.max(F.when(F.col("_d") == 1, F.col(value))).alias("_t1"),
            F.max(F.when(F.col("_d") == 2, F.col(value))).alias("_t2"),
            F.max("_d").alias("_n"),
        )
    )
    by = Window.partitionBy(*keys).orderBy(bucket)
    prev_one = F.lag("_n").over(by) == 1
    carried = tails.select(
        *keys, bucket, F.lag("_t1").over(by).alias("_p1"),
        F.when(prev_one, F.lag("_t1", 2).over(by)).otherwise(F.lag("_t2").over(by)).alias("_p2"),
    )
    local = df.withColumns({
        "_r": F.row_number().over(asc), "_l1": F.lag(value, 1).over(asc), "_l2": F.lag(value, 2).over(asc),
    })
    joined = attach(local, carried, [*keys, bucket], "inner")
    return joined.withColumns({
        "lag1": F.when(F.col("_r") == 1, F.col("_p1")).otherwise(F.col("_l1")),
        "lag2": F.when(F.col("_r") == 1, F.col("_p2")).when(F.col("_r") == 2, F.col("_p1")).otherwise(F.col("_l2")),
    }).drop("_r", "_l1", "_l2", "_p1", "_p2")
