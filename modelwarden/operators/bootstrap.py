"""Paired bootstrap comparison of candidates on one evaluation split, over all its rows.

A unit (a row, or a cluster of rows) stands in a replicate as often as a Poisson(1) variable says, read from the md5
bucket of (seed, replicate, unit) by the inverse distribution: every task can tell it without seeing other rows, and so
can another engine. Weights are then scaled so that each stratum keeps its share, as drawing a fixed number would.

Rows are added up in their task into a histogram of scores by replicate, whose size depends on settings and not on the
rows; AUC and average precision come from its prefix sums. Replicate -1 holds every unit once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import BUCKETS, digest
from .ordered import spread_attach

WHOLE = -1
PER_DIGEST = 4
TOGETHER = 4            # replicates that a row adds to at once, a multiple of PER_DIGEST; with many, the compiled sums are too long for the JVM to optimise
SCORE_BINS = 1 << 16


def poisson_limits(most: int = 16) -> list[int]:
    """Buckets at or above the k-th limit mean more than k draws (Poisson with mean 1, cut at ``most``)."""
    total, limits = 0.0, []
    for k in range(most):
        total += math.exp(-1.0) / math.factorial(k)
        limits.append(min(math.floor(total * BUCKETS + 0.5), BUCKETS))
    return limits


def draws(df: DataFrame, keys: Sequence[str | Column], replicates: int, seed: object) -> DataFrame:
    """Rows of ``df`` once per replicate that draws their unit, with ``replicate`` and ``times``; -1 has all once.

    One digest serves four replicates, eight hex digits each; block -1 is there for its last place, which is replicate -1.
    """
    blocks = F.sequence(F.lit(WHOLE), F.lit((replicates - 1) // PER_DIGEST))
    spread = df.select("*", F.explode(blocks).alias("_b"))
    spread = spread.select(*df.columns, "_b", digest([F.col("_b"), *keys], seed).alias("_h"))
    places = F.array(*[F.struct((F.col("_b") * PER_DIGEST + i).alias("replicate"), F.substring("_h", 1 + 8 * i, 8).alias("_u")) for i in range(PER_DIGEST)])
    drawn = spread.select(*df.columns, F.inline(places)).filter((F.col("replicate") >= WHOLE) & (F.col("replicate") < replicates))
    times = F.when(F.col("replicate") == WHOLE, 1).otherwise(_times(F.col("_u")))
    return drawn.select(*df.columns, "replicate", times.alias("times")).filter("times > 0")


def _times(place: Column) -> Column:
    """Draws that the eight hex digits of a place stand for; as text they sort as their numbers."""
    limits = [limit for limit in poisson_limits() if limit < BUCKETS]
    times = F.when(place < f"{limits[0]:08x}", 0)
    for k, limit in enumerate(limits[1:], 1):
        times = times.when(place < f"{limit:08x}", k)
    return times.otherwise(len(limits))


def _scaled(histogram: DataFrame, factors: DataFrame, stratum: str) -> DataFrame:
    """Positive and negative weight of each bin after scaling strata."""
    scaled = histogram.join(factors, ["replicate", stratum])
    return scaled.groupBy("replicate", "candidate", "bin").agg(
        F.sum(F.when(F.col("y") == 1, F.col("w") * F.col("factor")).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col("y") == 0, F.col("w") * F.col("factor")).otherwise(0.0)).alias("neg"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def _score(bins: DataFrame) -> DataFrame:
    """AUC and average precision per replicate and candidate.

    ``auc_slack`` bounds what the grid of scores can hide: half the pairs of both classes that share a bin but not a
    score, as a share of all pairs; 0 says that the AUC is that of the scores themselves.
    """
    down = Window.partitionBy("replicate", "candidate").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = bins.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down)})  # as many rows as the grid has bins
    s = r.groupBy("replicate", "candidate").agg(
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"), F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("_u"),
        F.sum(F.col("pos") * F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).alias("_ap"),
        F.sum(F.when(F.col("low") < F.col("high"), F.col("pos") * F.col("neg") / 2).otherwise(0.0)).alias("_hidden"))
    pairs = F.col("_P") * F.col("_N")
    return s.select(
        "replicate", "candidate", F.try_divide(F.col("_u"), pairs).alias("auc"),
        F.when(pairs > 0, F.try_divide(F.col("_ap"), F.col("_P"))).alias("average_precision"), F.try_divide(F.col("_hidden"), pairs).alias("auc_slack"))


def by_candidate(predictions: DataFrame) -> DataFrame:
    """Predictions with one row per candidate; rows may also hold all candidates as ``scores``, an array of (candidate, score)."""
    if "scores" not in predictions.columns:
        return predictions
    # inline would test the array's size first, evaluating it twice
    rows = predictions.select(*[c for c in predictions.columns if c != "scores"], F.posexplode_outer("scores").alias("_at", "_of"))
    return rows.filter("_at is not null").select("*", "_of.candidate", "_of.score").drop("_at", "_of")


def _candidates(predictions: DataFrame, *cols: str) -> DataFrame:
    """``cols`` and the candidate of each prediction; scores are not evaluated."""
    return predictions.select(*cols, "candidate" if "scores" not in predictions.columns else F.explode("scores.candidate").alias("candidate"))


def _histogram(predictions: DataFrame, units: Sequence[str], strata: Sequence[str], replicates: int, seed: object, bins: int) -> DataFrame:
    """Weight and range of scores per replicate, candidate, class, stratum and bin.

    A row adds to ``TOGETHER`` replicates at once, side by side in one record per bin; it is repeated once per so many
    replicates, not once per replicate. The records are turned into rows after they are complete. Where rows hold all
    candidates as ``scores``, their draws are found once, before candidates become rows.
    """
    scored = ["scores"] if "scores" in predictions.columns else ["candidate", "score"]
    rows = predictions.select(*dict.fromkeys([*units, "y", *strata]), *scored, F.col("weight").cast("double").alias("weight"))
    kept = list(dict.fromkeys(["y", *strata]))
    chunks = -(-replicates // TOGETHER)
    parts = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_c"))
    blocks = min(TOGETHER, -(-replicates // PER_DIGEST) * PER_DIGEST) // PER_DIGEST
    hashed = parts.withColumns({f"_h{j}": digest([(F.col("_c") * (TOGETHER // PER_DIGEST) + j).cast("int"), *units], seed) for j in range(blocks)})
    places = [(j * PER_DIGEST + i, F.substring(f"_h{j}", 1 + 8 * i, 8)) for j in range(blocks) for i in range(PER_DIGEST)]
    cut = hashed.select(*kept, "_c", *scored, "weight", *[place.alias(f"_u{n}") for n, place in places])
    times = cut.select(*kept, "_c", *scored, "weight", *[_times(F.col(f"_u{n}")).alias(f"_t{n}") for n, _ in places])
    score = F.col("score").cast("double")
    spot = F.least(F.floor(score * bins), F.lit(bins - 1)).cast("int")
    drawn = by_candidate(times).withColumns({"bin": spot, "score": score})
    by = ["candidate", *kept]
    seen = F.coalesce("score", F.lit(float("inf")))  # known wherever a row is drawn, so that bins without one can be told

    def place(number: Column, name: str, drawn_here: Column, weight: Column) -> tuple[list[Column], Column]:
        sums = [F.sum(weight).alias(f"w{name}"), F.min(F.when(drawn_here, seen)).alias(f"l{name}"), F.max(F.when(drawn_here, F.col("score"))).alias(f"x{name}")]
        return sums, F.struct(number.alias("replicate"), F.col(f"w{name}").alias("w"), F.col(f"l{name}").alias("low"), F.col(f"x{name}").alias("high"))

    cells = [place(F.when(F.col("_c") == 0, WHOLE), "_all", F.lit(True), F.col("weight"))]
    cells += [place((F.col("_c") * TOGETHER + n).cast("int"), str(n), F.col(f"_t{n}") > 0, F.col("weight") * F.col(f"_t{n}")) for n, _ in places]
    wide = drawn.groupBy(*by, "bin", "_c").agg(*[c for sums, _ in cells for c in sums])
    long = wide.select(*by, "bin", F.inline(F.array(*[cell for _, cell in cells])))
    return long.filter((F.col("replicate") < replicates) & F.col("low").isNotNull())


def class_draws(rows: DataFrame, key: str, replicates: int, seed: object) -> DataFrame:
    """Per class and replicate: rows drawn, their weight, and the factor that gives the class its whole weight back.

    Reads ``y`` and ``weight``, one row per key. A class with fewer than two rows is an error.
    """
    drawn = draws(rows.select(key, "y", F.col("weight").cast("double").alias("weight")), [key], replicates, seed)
    sums = drawn.groupBy("replicate", "y").agg(F.sum("times").alias("drawn"), F.sum(F.col("weight") * F.col("times")).alias("weight"))
    whole = lambda c: F.max(F.when(F.col("replicate") == WHOLE, F.col(c))).over(Window.partitionBy("y"))  # noqa: E731 - a row per replicate
    return sums.withColumns({"rows": whole("drawn"), "whole": whole("weight")}).select(
        "replicate", "y", "rows", "drawn", "weight", F.try_divide(F.col("whole"), F.col("weight")).alias("factor"))


def check_classes(draws: DataFrame) -> DataFrame:
    counts = draws.filter(F.col("replicate") == WHOLE).agg(F.count(F.lit(1)), F.min("rows")).first()
    if counts[0] < 2 or counts[1] < 2:
        raise ValueError("a bootstrap needs two rows in each class")
    return draws


def clusters_of(rows: DataFrame, group: str) -> DataFrame:
    """One row per cluster: its rows, and whether it holds a positive row (its stratum)."""
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("size"), F.max("y").cast("int").alias("stratum"))


def cluster_draws(clusters: DataFrame, group: str, replicates: int, seed: object) -> DataFrame:
    """Per stratum and replicate: clusters and rows drawn, and the factor that keeps the number of clusters."""
    drawn = draws(clusters.select(group, "stratum", "size"), [group], replicates, seed)
    sums = drawn.groupBy("replicate", "stratum").agg(F.sum("times").alias("drawn"), F.sum(F.col("size") * F.col("times")).alias("rows"))
    whole = F.max(F.when(F.col("replicate") == WHOLE, F.col("drawn"))).over(Window.partitionBy("stratum"))  # a row per replicate
    return sums.withColumn("clusters", whole).select(
        "replicate", "stratum", "clusters", "drawn", "rows", F.try_divide(F.col("clusters"), F.col("drawn")).alias("factor"))


def check_clusters(draws: DataFrame) -> DataFrame:
    if (draws.filter(F.col("replicate") == WHOLE).agg(F.sum("clusters")).first()[0] or 0) < 4:
        raise ValueError("a cluster bootstrap needs four clusters")
    return draws


def row_bootstrap(predictions: DataFrame, key: str, replicates: int, seed: object, bins: int = SCORE_BINS, check: bool = True,
                  hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """AUC and average precision per replicate and candidate, rows drawn within each class, paired over candidates.

    Reads ``key``, ``candidate``, ``y``, ``score`` in [0, 1] and ``weight``, or ``scores`` (see :func:`by_candidate`);
    one scan of them. ``bins`` is the grid of scores that the histogram keeps apart; ``hold`` keeps the histogram, which
    is read twice.
    """
    histogram = hold(_histogram(predictions, [key], ["y"], replicates, seed, bins))
    totals = histogram.groupBy("replicate", "candidate", "y").agg(F.sum("w").alias("sum"))
    whole = totals.filter(F.col("replicate") == WHOLE).select("candidate", "y", F.col("sum").alias("whole"))
    factors = totals.join(whole, ["candidate", "y"]).groupBy("replicate", "y").agg(F.max(F.try_divide(F.col("whole"), F.col("sum"))).alias("factor"))
    if check:
        one = _candidates(predictions, "y").groupBy("candidate", "y").agg(F.count(F.lit(1)).alias("n")).groupBy("candidate").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"))
        if one.filter("k < 2 or n < 2").take(1):
            raise ValueError("a bootstrap needs two rows in each class")
    return _score(_scaled(histogram, factors, "y")).filter(F.col("replicate") != WHOLE)


def cluster_bootstrap(predictions: DataFrame, group: str, replicates: int, seed: object, bins: int = SCORE_BINS, check: bool = True,
                      hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The same with whole clusters drawn within the two strata of clusters with and without a positive row.

    ``hold`` keeps the clusters and the factors of their strata, which are read several times; pass a function that writes them.
    """
    one = _candidates(predictions, group, "y").groupBy(group, "candidate").agg(F.count(F.lit(1)).alias("n"), F.max("y").cast("int").alias("y"))
    clusters = hold(one.groupBy(group).agg(F.max("n").alias("size"), F.max("y").alias("stratum")))
    factors = hold(cluster_draws(clusters, group, replicates, seed))
    if check:
        check_clusters(factors)
    placed = spread_attach(predictions, clusters.select(group, "stratum", "size"), [group], "inner", rows="size")
    histogram = _histogram(placed, [group], ["y", "stratum"], replicates, seed, bins)
    return _score(_scaled(histogram, factors.select("replicate", "stratum", "factor"), "stratum")).filter(F.col("replicate") != WHOLE)


def confidence(points: DataFrame, replicates: DataFrame, level: float = 0.95, margin: float = 0.0) -> DataFrame:
    """Centred confidence interval per candidate and for its difference to the best candidate.

    ``points`` holds (candidate, n_features, point); ``replicates`` (replicate, candidate, value).
    Quantiles interpolate over the replicates, whose number is a setting.
    """
    alpha = (1.0 - level) / 2.0
    best = points.orderBy(F.col("point").desc(), "candidate").limit(1).select(
        F.col("candidate").alias("reference"), F.col("point").alias("ref_point"))
    ref = replicates.join(F.broadcast(best), replicates.candidate == F.col("reference")).select("replicate", F.col("value").alias("ref_value"))
    pairs = replicates.join(ref, "replicate").withColumn("delta", F.col("value") - F.col("ref_value"))
    stats = pairs.groupBy("candidate").agg(
        F.avg("value").alias("m"), F.percentile("value", F.lit(alpha)).alias("lo"), F.percentile("value", F.lit(1 - alpha)).alias("hi"),
        F.stddev_samp("value").alias("bootstrap_std"), F.avg("delta").alias("dm"),
        F.percentile("delta", F.lit(alpha)).alias("dlo"), F.percentile("delta", F.lit(1 - alpha)).alias("dhi"))
    delta = F.col("point") - F.col("ref_point")
    out = points.join(stats, "candidate").crossJoin(F.broadcast(best)).select(
        "candidate", "n_features", "point", (F.col("point") + F.col("lo") - F.col("m")).alias("ci_low"),
        (F.col("point") + F.col("hi") - F.col("m")).alias("ci_high"), "bootstrap_std", "reference", delta.alias("delta"),
        (delta + F.col("dlo") - F.col("dm")).alias("delta_ci_low"), (delta + F.col("dhi") - F.col("dm")).alias("delta_ci_high"))
    return out.withColumn("noninferior", F.col("delta_ci_low") >= -margin)


def winner(intervals: DataFrame, eligible: DataFrame | None = None, margin: float = 0.0) -> DataFrame:
    """Smallest eligible candidate that is not inferior, else the one with the best lower bound."""
    pool = intervals if eligible is None else intervals.join(eligible.select("candidate").distinct(), "candidate", "left_semi")
    top = intervals.agg(F.max("ci_low").alias("best_low"))
    ranked = pool.crossJoin(F.broadcast(top)).withColumn("good", F.col("noninferior") & (F.col("ci_low") >= F.col("best_low") - margin))
    order = [
        F.col("good").desc(), F.when(F.col("good"), F.col("n_features")).asc_nulls_last(), F.col("ci_low").desc(), F.col("point").desc(),
        F.col("n_features"), F.col("candidate"),
    ]
    return ranked.orderBy(*order).limit(1).drop("best_low", "good")

