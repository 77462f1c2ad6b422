"""Statistics over feature-subset trials.

A trial holds ``trial_id``, ``fidelity``, ``method``, ``features`` (array of text), ``n_features``,
``valid_metric``, ``metric_std`` and ``constraint_violation``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import bucket
from ..sources.contract import literal_rows
from .ordered import attach, balanced_buckets
from .state import take_latest

INF = float("inf")


def with_key(trials: DataFrame) -> DataFrame:
    """Sorted distinct features and their text key."""
    s = F.array_sort(F.array_distinct("features"))
    return trials.withColumn("features", s).withColumn("subset_key", F.concat_ws("|", s)).withColumn("n_features", F.size(s))


def rank_order() -> list[Column]:
    """Better first: least violation, highest metric, fewest features, least spread, then id."""
    return [
        F.coalesce("constraint_violation", F.lit(INF)).asc(), F.col("valid_metric").desc_nulls_last(), F.col("n_features").asc(),
        F.coalesce("metric_std", F.lit(INF)).asc(), F.col("trial_id").asc(),
    ]


def best_per_subset(trials: DataFrame) -> DataFrame:
    """Best trial per fidelity and feature subset."""
    return take_latest(with_key(trials), ["fidelity", "subset_key"], rank_order())


def pareto_two(trials: DataFrame) -> DataFrame:
    """Feasible trials that no other beats on metric and size at once.

    Best metric per size, then a running maximum over the sizes; sizes are few.
    """
    ok = trials.filter((F.coalesce("constraint_violation", F.lit(0.0)) <= 1e-12) & F.col("valid_metric").isNotNull())
    best = ok.groupBy("n_features").agg(F.max("valid_metric").alias("_best"))
    smaller = Window.orderBy("n_features").rowsBetween(Window.unboundedPreceding, -1)
    steps = best.withColumn("_seen", F.max("_best").over(smaller)).filter("_seen is null or _best > _seen")
    return ok.join(F.broadcast(steps), "n_features").filter("valid_metric = _best").drop("_best", "_seen")  # one row per size


def _staircase(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tuples with a smaller spread than every tuple of at least their metric in the group."""
    w = Window.partitionBy(*keys).orderBy(F.col("m").desc(), F.col("s")).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_low", F.min("s").over(w)).filter("_low is null or s < _low").drop("_low")


CHUNKS = 256


def pareto_three(trials: DataFrame) -> DataFrame:
    """Trials that no other dominates on metric, size and spread; least violation comes first.

    No pairs are formed. Distinct objective tuples are cut into hash chunks and each chunk keeps
    its own staircase, since what a chunk already beats cannot be on the front; the few survivors
    of a size then form its staircase. Last, a tuple must beat the least spread that any smaller
    size reaches at its metric or above. Sizes are few.
    """
    least = trials.agg(F.min("constraint_violation").alias("_v"))
    top = trials.crossJoin(F.broadcast(least)).filter(F.col("constraint_violation") == F.col("_v")).drop("_v")
    tuples = top.select(F.col("n_features").alias("n"), F.col("valid_metric").alias("m"), F.col("metric_std").alias("s")).distinct()
    chunked = tuples.withColumn("_c", F.pmod(F.xxhash64("n", "m", "s"), F.lit(CHUNKS)))
    stairs = _staircase(_staircase(chunked, ["n", "_c"]).drop("_c"), ["n"])
    top_size = trials.agg(F.max("n_features").alias("_hi"))
    spread = stairs.crossJoin(F.broadcast(top_size)).select(
        "m", "s", "n", F.explode(F.sequence("n", "_hi")).alias("k")).withColumn("c", (F.col("k") > F.col("n")).cast("int"))
    w = Window.partitionBy("k").orderBy(F.col("m").desc(), F.col("c").desc(), "s").rowsBetween(Window.unboundedPreceding, -1)
    low = F.min(F.when(F.col("c") == 1, F.col("s"))).over(w)
    front = spread.withColumn("_low", low).filter("c = 0 and (_low is null or s < _low)").select(
        F.col("n").alias("n_features"), F.col("m").alias("valid_metric"), F.col("s").alias("metric_std"))
    return top.join(front, ["n_features", "valid_metric", "metric_std"], "left_semi").select(*trials.columns)


def layers(trials: DataFrame, depth: int, hold=lambda df: df) -> DataFrame:
    """First ``depth`` non-dominated layers with their number.

    ``hold`` is applied to what is left after each layer; pass ``DataFrame.checkpoint`` when the
    depth is more than a few, so that the plan does not grow.
    """
    out, rest = None, trials
    for i in range(1, depth + 1):
        front = pareto_three(rest).withColumn("layer", F.lit(i))
        out = front if out is None else out.unionByName(front)
        if i < depth:
            rest = hold(rest.join(front, "trial_id", "left_anti"))
    return out


def crowding(layered: DataFrame) -> DataFrame:
    """Crowding distance within each layer; extremes of any objective get infinity."""
    parts = []
    for c, sign in (("valid_metric", 1.0), ("n_features", -1.0), ("metric_std", -1.0)):
        v = (F.col(c) * sign).cast("double")
        w = Window.partitionBy("layer").orderBy(v, "trial_id")
        whole = Window.partitionBy("layer")
        before, after = F.lag(v).over(w), F.lead(v).over(w)
        spread = F.max(v).over(whole) - F.min(v).over(whole)
        inner = F.when(spread > 0, F.try_divide(after - before, spread)).otherwise(F.lit(0.0))
        parts.append(F.when(before.isNull() | after.isNull(), F.lit(INF)).otherwise(inner))
    return layered.withColumn("crowding", parts[0] + parts[1] + parts[2])


def nsga_select(trials: DataFrame, size: int, hold) -> DataFrame:
    """``size`` trials: whole layers first, then the least crowded of the layer that overflows.

    ``hold`` cuts the plan between layers (a checkpoint or a written table).
    """
    taken, rest, room, layer = [], hold(trials), size, 1
    while room > 0:
        front = hold(pareto_three(rest).withColumn("layer", F.lit(layer)))
        n = front.count()
        if n == 0:
            break
        ranked = crowding(front)
        if n > room:
            ranked = ranked.orderBy(F.col("crowding").desc(), "trial_id").limit(room)
        taken.append(ranked)
        room, layer = room - n, layer + 1
        rest = hold(rest.join(front, "trial_id", "left_anti"))
    if not taken:
        return trials.limit(0)
    out = taken[0]
    for t in taken[1:]:
        out = out.unionByName(t)
    return out


def promotion_size(screened: DataFrame, strategy: str, fraction: float, min_promoted: int, min_fraction: float = 0.0,
                   max_fraction: float = 1.0, band: float = 0.0) -> DataFrame:
    """How many screened trials go on: a fixed share, or the ambiguous ones within limits."""
    total = screened.agg(F.count(F.lit(1)).alias("screened"), F.max(F.when(F.col("constraint_violation") == 0, F.col("valid_metric"))).alias("_bf"),
                         F.max("valid_metric").alias("_ba"))
    front = pareto_three(screened).select("subset_key").distinct().withColumn("_p", F.lit(1))
    near = screened.crossJoin(F.broadcast(total)).withColumn(
        "_n", ((F.col("_bf").isNull() | (F.col("constraint_violation") == 0)) & (F.col("valid_metric") >= F.coalesce("_bf", "_ba") - band)).cast("int"))
    marks = near.join(front, "subset_key", "left").agg(
        F.coalesce(F.sum("_p"), F.lit(0)).alias("pareto_candidates"), F.sum("_n").alias("near_best_candidates"),
        F.countDistinct(F.when((F.col("_p") == 1) | (F.col("_n") == 1), F.col("subset_key"))).alias("_amb"))
    row = total.crossJoin(F.broadcast(marks))

    def up(f: float) -> Column:
        return F.greatest(F.lit(min_promoted).cast("long"), F.ceil(F.col("screened") * F.lit(f) - F.lit(1e-9)))

    if strategy == "fixed":
        promoted = up(fraction)
    else:
        lower = up(min_fraction)
        promoted = F.least(F.greatest(lower, up(max_fraction)), F.greatest(lower, F.col("_amb")))
    return row.select("screened", "pareto_candidates", "near_best_candidates", F.least(F.col("screened"), promoted).alias("promoted"))


def _combinations(features: Column, order: int) -> Column:
    """All sorted pairs or triples of one trial's own features as an array of arrays."""
    n = F.size(features)

    def tail(i: Column) -> Column:
        return F.slice(features, i + 2, F.greatest(n - i - 1, F.lit(0)))

    def pairs(x: Column, i: Column) -> Column:
        return F.transform(tail(i), lambda y: F.array(x, y))

    if order == 2:
        return F.flatten(F.transform(features, pairs))

    def triples(x: Column, i: Column) -> Column:
        rest = tail(i)
        return F.flatten(F.transform(rest, lambda y, j: F.transform(
            F.slice(rest, j + 2, F.greatest(F.size(rest) - j - 1, F.lit(0))), lambda z: F.array(x, y, z))))

    return F.flatten(F.transform(features, triples))


def coalitions(trials: DataFrame, elite_fraction: float, smoothing: float, min_support: int, orders: Sequence[int] = (2, 3)) -> DataFrame:
    """Feature pairs and triples that occur in good trials more than in all.

    Combinations stay inside a trial; counting combines before the shuffle. Their number grows with the cube of a
    trial's size, so wide trials are better asked for pairs alone (``orders``).
    """
    sized = take_latest(with_key(trials), ["subset_key"], rank_order())
    facts = sized.agg(F.count(F.lit(1)).alias("_n"), F.avg("valid_metric").alias("_g"), F.stddev_pop("valid_metric").alias("_sd"))
    facts = facts.withColumn("_e", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_n") * F.lit(elite_fraction) - F.lit(1e-9))))
    elite = _first_n(sized, facts.select(F.col("_e").alias("quota"))).select("subset_key").withColumn("_elite", F.lit(1))
    members = F.explode(F.concat(*[_combinations(F.col("features"), o) for o in orders]))
    rows = sized.join(elite, "subset_key", "left").select("valid_metric", F.coalesce("_elite", F.lit(0)).alias("_elite"), members.alias("members"))
    stats = rows.groupBy("members").agg(
        F.count(F.lit(1)).alias("support"), F.sum("_elite").alias("elite_support"), F.sum("valid_metric").alias("_sum"))
    s = F.lit(float(smoothing))
    scored = stats.filter((F.col("support") >= min_support) & (F.col("elite_support") > 0)).crossJoin(F.broadcast(facts))
    lift = F.log(((F.col("elite_support") + s) / (F.col("_e") + 2 * s)) / ((F.col("support") + s) / (F.col("_n") + 2 * s)))
    mean = (F.col("_sum") + s * F.col("_g")) / (F.col("support") + s)
    gain = mean - F.col("_g")
    scaled = F.greatest(F.lit(-5.0), F.least(F.lit(5.0), gain / F.greatest(F.col("_sd"), F.lit(1e-12))))
    score = F.greatest(F.lit(0.0), lift + scaled) * F.col("support") / (F.col("support") + s)
    return scored.select(
        F.concat_ws("|", "members").alias("members"), F.size("members").alias("order"), "support", "elite_support", lift.alias("lift"),
        mean.alias("mean_metric"), gain.alias("metric_gain"), score.alias("score")).filter("score > 0")


def _first_n(trials: DataFrame, quota: DataFrame) -> DataFrame:
    """First ``quota`` trials in rank order without sorting all trials in one task.

    The metric value at the quota bounds the candidates; only those at the bound are ordered.
    """
    from .ordered import bucketed_row_number

    v = trials.withColumn("_m", F.when(F.col("constraint_violation").isNull() | F.col("valid_metric").isNull(), F.lit(-INF)).otherwise(
        -F.col("constraint_violation") * 1e6 + F.col("valid_metric")))
    b = balanced_buckets(v, [], "_m").withColumn("_b", -F.col("_b"))
    ranked = bucketed_row_number(b, [], "_b", rank_order(), "_rank")
    return ranked.crossJoin(F.broadcast(quota)).filter("_rank <= quota").select(*trials.columns)


def top_trials(trials: DataFrame, n: int) -> DataFrame:
    """Best n trials; each task keeps at most n before the final merge."""
    return trials.orderBy(*rank_order()).limit(n)


def feature_frequency(trials: DataFrame, total: str = "frequency") -> DataFrame:
    n = trials.agg(F.count(F.lit(1)).alias("_n"))
    counts = trials.select(F.explode(F.array_distinct("features")).alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("count"))
    return counts.crossJoin(F.broadcast(n)).select("feature", "count", (F.col("count") / F.col("_n")).alias(total))


def pair_frequency(trials: DataFrame, total: str = "frequency") -> DataFrame:
    n = trials.agg(F.count(F.lit(1)).alias("_n"))
    pairs = with_key(trials).select(F.explode(_combinations(F.col("features"), 2)).alias("p"))
    counts = pairs.groupBy(F.col("p")[0].alias("first"), F.col("p")[1].alias("second")).agg(F.count(F.lit(1)).alias("count"))
    return counts.crossJoin(F.broadcast(n)).select("first", "second", "count", (F.col("count") / F.col("_n")).alias(total))


def _min_count(freq: float) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(freq) * F.col("_n") - F.lit(1e-12)))


def feature_stability(folds: DataFrame, candidate_freq: float, core_freq: float, max_candidates: int, minimum_pool: int = 1,
                      always_keep: Sequence[str] = ()) -> DataFrame:
    """Per feature: folds it was selected in, stable core, candidate pool topped up to a minimum."""
    n = folds.agg(F.count(F.lit(1)).alias("_n"))
    counts = folds.select(F.explode(F.array_distinct("features")).alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("count"))
    if always_keep:
        extra = literal_rows(folds.sparkSession, [(f,) for f in always_keep], "feature string")
        counts = counts.join(extra, "feature", "full").fillna(0, ["count"])
    w = Window.orderBy(F.col("count").desc(), "feature")        # one row per feature
    r = counts.crossJoin(F.broadcast(n)).withColumn("rank", F.row_number().over(w))
    by_freq = (F.col("count") >= _min_count(candidate_freq)) & (F.col("rank") <= max_candidates)
    kept = F.col("feature").isin(*always_keep) if always_keep else F.lit(False)
    pool = by_freq | kept | (F.col("rank") <= minimum_pool)
    return r.select("feature", "count", (F.col("count") / F.col("_n")).alias("frequency"), "rank",
                    (F.col("count") >= _min_count(core_freq)).alias("stable_core"), pool.alias("candidate_pool"))


def stable_pairs(folds: DataFrame, pair_freq: float, max_pairs: int) -> DataFrame:
    n = folds.agg(F.count(F.lit(1)).alias("_n"))
    p = pair_frequency(folds).crossJoin(F.broadcast(n)).filter(F.col("count") >= _min_count(pair_freq))
    return p.orderBy(F.col("count").desc(), "first", "second").limit(max_pairs).drop("_n")


def size_statistics(folds: DataFrame) -> DataFrame:
    s = F.size(F.array_distinct("features"))
    return folds.agg(F.count(F.lit(1)).alias("runs"), F.min(s).alias("min_size"), F.max(s).alias("max_size"), F.avg(s).alias("mean_size"))


def pairwise_jaccard(runs: DataFrame, by: Sequence[str] = (), salts: int = 8) -> DataFrame:
    """Least, mean and greatest Jaccard similarity over all pairs of runs of a group.

    Equal subsets are merged first. Only subsets that share a feature meet, through rows of (feature, subset); each feature
    is dealt to ``salts`` parts, so that a frequent one is no single task. Pairs with nothing in common enter as zeros by
    their number alone.
    """
    sets = with_key(runs).groupBy(*by, "subset_key", "features").agg(F.count(F.lit(1)).alias("times"))
    totals = sets.groupBy(*by).agg(F.sum("times").alias("runs"), F.sum(F.col("times") * (F.col("times") - 1) / 2).alias("_same"))
    held = sets.select(*by, F.explode("features").alias("_f"), "subset_key", F.size("features").alias("n"), "times")
    parts = F.array(*[F.lit(i) for i in range(salts)])
    a = held.select(*by, "_f", F.col("subset_key").alias("ka"), F.col("n").alias("na"), F.col("times").alias("ta"), F.explode(parts).alias("_part"))
    b = held.select(*by, "_f", F.col("subset_key").alias("kb"), F.col("n").alias("nb"), F.col("times").alias("tb"),
                    F.pmod(F.xxhash64("subset_key"), F.lit(salts)).cast("int").alias("_part"))
    met = a.join(b, [*by, "_f", "_part"]).filter("ka < kb").groupBy(*by, "ka", "kb").agg(
        F.count(F.lit(1)).alias("both"), F.first("na").alias("na"), F.first("nb").alias("nb"), F.first("ta").alias("ta"), F.first("tb").alias("tb"))
    j, w = F.col("both") / (F.col("na") + F.col("nb") - F.col("both")), F.col("ta") * F.col("tb")
    shared = met.groupBy(*by).agg(F.min(j).alias("_low"), F.max(j).alias("_high"), F.sum(j * w).alias("_sum"), F.sum(w).alias("_met"))
    pairs = F.col("runs") * (F.col("runs") - 1) / 2
    apart = pairs > F.col("_same") + F.col("_met")
    low = F.when(apart, F.lit(0.0)).otherwise(F.coalesce("_low", F.lit(1.0)))
    high = F.when(F.col("_same") > 0, F.lit(1.0)).otherwise(F.coalesce("_high", F.lit(0.0)))
    known = attach(totals, shared, by).fillna(0.0, ["_sum"]).fillna(0, ["_met"])
    one = lambda c: F.when(pairs > 0, c).otherwise(F.lit(1.0))
    return known.select(
        *by, "runs", one(low).alias("min_jaccard"), one((F.col("_sum") + F.col("_same")) / F.greatest(pairs, F.lit(1.0))).alias("mean_jaccard"),
        one(high).alias("max_jaccard"))


def choose_compact(front: DataFrame, allowed_drop: float) -> DataFrame:
    """Smallest trial within an allowed drop from the best; feasible trials first."""
    best = front.agg(F.max(F.when(F.col("constraint_violation") == 0, F.col("valid_metric"))).alias("_bf"), F.max("valid_metric").alias("_ba"))
    ok = (F.col("_bf").isNull() | (F.col("constraint_violation") == 0)) & (F.col("valid_metric") >= F.coalesce("_bf", "_ba") - allowed_drop)
    return front.crossJoin(F.broadcast(best)).filter(ok).orderBy("n_features", "metric_std", F.col("valid_metric").desc(), "trial_id").limit(1).drop("_bf", "_ba")


def finalists(front: DataFrame, limit: int, allowed_drop: float) -> DataFrame:
    """Anchors (best, smallest, compact) and trials evenly spaced by size; a front is small."""
    by_size = Window.orderBy("n_features", F.col("valid_metric").desc(), "trial_id")
    numbered = front.withColumn("_pos", F.row_number().over(by_size) - 1)
    n = front.agg((F.count(F.lit(1)) - 1).alias("_last"))
    spaced = max(limit - 3, 0)
    steps = literal_rows(front.sparkSession, [(i,) for i in range(spaced)], "i int")
    at = steps.crossJoin(F.broadcast(n)).select(F.bround(F.col("i") * F.col("_last") / F.lit(float(max(1, spaced - 1)))).cast("int").alias("_pos"), F.lit(4).alias("_why"))
    even = numbered.join(at.distinct(), "_pos").select("trial_id", "_why")
    best = front.orderBy(F.col("valid_metric").desc(), "trial_id").limit(1).select("trial_id", F.lit(1).alias("_why"))
    small = front.orderBy("n_features", F.col("valid_metric").desc(), "trial_id").limit(1).select("trial_id", F.lit(2).alias("_why"))
    compact = choose_compact(front, allowed_drop).select("trial_id", F.lit(3).alias("_why"))
    fill = front.select("trial_id", F.lit(5).alias("_why"))
    order = best.unionByName(small).unionByName(compact).unionByName(even).unionByName(fill).groupBy("trial_id").agg(F.min("_why").alias("_why"))
    return front.join(order, "trial_id").orderBy("_why", F.col("valid_metric").desc(), "trial_id").limit(limit).drop("_why")


def synergy(scored: DataFrame, requests: DataFrame) -> DataFrame:
    """q(ab) - q(a) - q(b) + q(rest) for requested pairs, looked up among scored subsets.

    ``requests`` holds ``features`` (the whole subset), ``first`` and ``second``.
    """
    def key(a: Column) -> Column:
        return F.concat_ws("|", F.array_sort(a))

    rest = F.array_except("features", F.array("first", "second"))
    r = requests.select(
        "first", "second", key(F.col("features")).alias("k_pair"), F.size(rest).alias("background_size"), key(rest).alias("k_background"),
        key(F.concat(rest, F.array("first"))).alias("k_first"), key(F.concat(rest, F.array("second"))).alias("k_second")
    ).filter("background_size > 0")
    q = scored.groupBy("subset_key").agg(F.max("valid_metric").alias("q"))
    for part in ("pair", "background", "first", "second"):
        r = r.join(q.select(F.col("subset_key").alias(f"k_{part}"), F.col("q").alias(f"score_{part}")), f"k_{part}")
    return r.select(
        F.col("k_pair").alias("subset_key"), "first", "second", "background_size", "score_background", "score_first", "score_second", "score_pair",
        (F.col("score_pair") - F.col("score_first") - F.col("score_second") + F.col("score_background")).alias("synergy"))


def size_frontier(trials: DataFrame) -> DataFrame:
    return trials.filter("valid_metric is not null").groupBy("n_features").agg(F.max("valid_metric").alias("best_metric"))


def confirmation_summary(runs: DataFrame) -> DataFrame:
    """Mean, spread and subset similarity per method over its confirmation runs."""
    stats = runs.groupBy("method").agg(
        F.count(F.lit(1)).alias("runs"), F.avg("valid_metric").alias("metric_mean"), F.stddev_samp("valid_metric").alias("metric_std"),
        F.avg("n_features").alias("n_features_mean"))
    j = pairwise_jaccard(runs, ["method"]).select("method", "mean_jaccard")
    return stats.join(j, "method")


def top_sets(trials: DataFrame, k: int) -> DataFrame:
    """Best k distinct subsets per method."""
    best = take_latest(with_key(trials).filter("n_features > 0"), ["method", "subset_key"], [F.col("valid_metric").desc_nulls_last(), F.col("trial_id").asc()])
    w = Window.partitionBy("method").orderBy(F.col("valid_metric").desc_nulls_last(), "subset_key")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def subspace_proposals(proposals: DataFrame, features: DataFrame, min_size: int, max_size: int, seed: object, required: Sequence[str] = (),
                       elite_floor: float | None = None) -> DataFrame:
    """One random feature subset per proposal id; duplicates are removed.

    ``features`` holds ``feature`` and, for the weighted form, ``weight`` (elite frequency). Keys
    are ``-ln(u) / weight`` per proposal and feature, so the smallest keys are a weighted draw
    without replacement. The feature list is small.
    """
    weighted = elite_floor is not None
    f = features.select("feature", (F.lit(elite_floor) + F.col("weight") if weighted else F.lit(1.0)).alias("w"))
    size = F.lit(min_size) + (bucket(["proposal"], f"{seed}:size") % F.lit(max_size - min_size + 1)).cast("int")
    grid = proposals.select("proposal").withColumn("size", size).crossJoin(F.broadcast(f))
    u = (bucket(["proposal", "feature"], seed) + F.lit(1)) / F.lit(float((1 << 32) + 1))
    must = F.col("feature").isin(*required) if required else F.lit(False)
    keyed = grid.withColumn("_k", F.when(must, F.lit(-1.0)).otherwise(-F.log(u) / F.greatest(F.col("w"), F.lit(1e-6))))
    per = keyed.groupBy("proposal", "size").agg(F.sort_array(F.collect_list(F.struct("_k", "feature"))).alias("_s"))
    chosen = per.select("proposal", F.array_sort(F.transform(F.slice("_s", F.lit(1), F.col("size")), lambda x: x.feature)).alias("features"))
    return with_key(chosen).groupBy("subset_key", "features", "n_features").agg(F.min("proposal").alias("proposal"))


# --- run telemetry ------------------------------------------------------------------

def resource_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("observations"), F.max("active_trials").alias("max_active_trials"), F.max("pending_trials").alias("max_pending_trials"),
        F.max("cpu_percent").alias("max_cpu_percent"), F.min("ram_available_gb").alias("min_ram_available_gb"),
        F.sum(((F.col("allowed_trials") == 0) & (F.col("pending_trials") > 0)).cast("long")).alias("zero_allowed_with_pending"))


def device_minimum(rows: DataFrame) -> DataFrame:
    """Least free memory per device over all observations."""
    return rows.select(F.inline("gpus")).groupBy("device").agg(F.min("free_gb").alias("min_free_gb"))


def failure_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("termination_reason", F.lit("none")).alias("termination_reason"),
                        F.coalesce("error_type", F.lit("unknown")).alias("error_type")).agg(
        F.count(F.lit(1)).alias("trials"), F.sum(F.coalesce("oom_detected", F.lit(False)).cast("long")).alias("oom_trials"))
