"""Train / valid / holdout roles and folds as columns of one frame."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit_bucket
from ..sources.contract import literal_rows
from .ordered import exact_quantiles, spread_attach

ROLES = ("train", "valid", "oos", "oot", "test")
MODES = ("random", "stratified", "group", "temporal", "group_temporal")
TOLERANCE = 1e-9


@dataclass(frozen=True)
class SplitConfig:
    """What to split by, and how much goes to each role."""

    keys: tuple[str, ...]
    target: str
    fractions: Mapping[str, float]
    mode: str = "auto"
    time: str | None = None
    groups: tuple[str, ...] = field(default_factory=tuple)
    seed: int = 42
    purge_history: bool = True
    null_time_to_first: bool = True
    n_folds: int = 5
    repeats: int = 1
    seed_stride: int = 1009
    temporal_min_train: float = 0.5

    def resolved(self) -> str:
        if self.mode != "auto":
            return self.mode
        if self.time:
            return "group_temporal" if self.groups else "temporal"
        return "group" if self.groups else "stratified"

    def share(self, role: str) -> float:
        return float(self.fractions.get(role, 0.0))

    def problems(self) -> list[str]:
        """Rule violations in words; empty when the configuration is usable."""
        out, mode = [], self.resolved()
        if mode not in MODES:
            return [f"unknown mode {mode}"]
        if not self.keys:
            out.append("key columns are required")
        if any(not 0 <= v < 1 for v in self.fractions.values()):
            out.append("each fraction lies in [0, 1)")
        if self.share("train") <= 0 or self.share("valid") <= 0:
            out.append("train and valid need a positive fraction")
        if abs(sum(self.fractions.values()) - 1.0) > TOLERANCE:
            out.append("fractions sum to 1")
        final = self.share("oot") + self.share("test")
        if "temporal" in mode:
            if not self.time:
                out.append(f"{mode} needs a time column")
            if final <= 0:
                out.append(f"{mode} needs an oot or test fraction")
        elif self.share("oot") != 0:
            out.append("an out-of-time part needs a temporal mode")
        if "group" in mode and not self.groups:
            out.append(f"{mode} needs group columns")
        if self.n_folds < 2:
            out.append("at least two folds")
        if self.repeats < 1:
            out.append("at least one repeat")
        if not 0 < self.temporal_min_train < 1:
            out.append("temporal_min_train lies in (0, 1)")
        return out

    def validate(self) -> SplitConfig:
        if self.problems():
            raise ValueError("; ".join(self.problems()))
        return self

    def hash_columns(self) -> tuple[str, ...]:
        mode = self.resolved()
        if "group" in mode:
            return self.groups
        return (*self.keys, self.target) if mode == "stratified" else self.keys


def _by_shares(u: Column, shares: Sequence[tuple[str, float]]) -> Column:
    """Cumulative ranges over [0, 1); the last role takes the rest."""
    total = sum(s for _, s in shares)
    out, upper = None, 0.0
    for role, share in shares[:-1]:
        upper += share / total
        out = (F.when if out is None else out.when)(u < F.lit(upper), F.lit(role))
    last = F.lit(shares[-1][0])
    return last if out is None else out.otherwise(last)


def hash_roles(df: DataFrame, cfg: SplitConfig, roles: Sequence[str] = ("train", "valid", "oos", "test")) -> DataFrame:
    """random, stratified or group: one hash per row decides the role, no shuffle."""
    shares = [(r, cfg.share(r)) for r in roles if cfg.share(r) > 0]
    return df.withColumn("role", _by_shares(unit_bucket(cfg.hash_columns(), cfg.seed), shares))


def time_cutoffs(df: DataFrame, time: str, fractions: Mapping[str, float]) -> DataFrame:
    """One row of nearest-rank time quantiles, exact at any size."""
    return exact_quantiles(df.select(F.col(time).cast("timestamp").alias("_t")), [], "_t", fractions, rule="nearest").drop("n")


def temporal_roles(df: DataFrame, cfg: SplitConfig) -> DataFrame:
    """Consecutive time windows; a missing time belongs to the first one."""
    roles = [r for r in ROLES if cfg.share(r) > 0]
    points, cum = {}, 0.0
    for r in roles[:-1]:
        cum += cfg.share(r)
        points[f"_cut_{r}"] = cum
    cuts = time_cutoffs(df, cfg.time, points)
    t = F.col(cfg.time).cast("timestamp")
    role = F.when(t.isNull(), F.lit(roles[0]) if cfg.null_time_to_first else F.lit(None))
    for r in roles[:-1]:
        role = role.when(t <= F.col(f"_cut_{r}"), F.lit(r))
    return df.crossJoin(F.broadcast(cuts)).withColumn("role", role.otherwise(F.lit(roles[-1]))).drop(*points)


def group_temporal_roles(df: DataFrame, cfg: SplitConfig) -> DataFrame:
    """Late holdouts by time, history by group hash; role ``purged`` marks leaking rows.

    Groups seen in the test window are taken out of the out-of-time window, and groups seen in
    any remaining holdout row are taken out of the history. Group facts are one aggregate, so a
    group of any size costs one row per task in the shuffle.
    """
    final = cfg.share("oot") + cfg.share("test")
    points = {"_history": 1.0 - final}
    if cfg.share("oot") > 0 and cfg.share("test") > 0:
        points["_oot"] = 1.0 - cfg.share("test")
    cuts = time_cutoffs(df, cfg.time, points)
    t = F.col(cfg.time).cast("timestamp")
    late = "oot" if cfg.share("oot") > 0 else "test"
    window = F.when(t.isNull() | (t <= F.col("_history")), F.lit("history"))
    if "_oot" in points:
        window = window.when(t <= F.col("_oot"), F.lit("oot")).otherwise(F.lit("test"))
    else:
        window = window.otherwise(F.lit(late))
    w = df.crossJoin(F.broadcast(cuts)).withColumn("_w", window).drop(*points)
    seen = w.groupBy(*cfg.groups).agg(
        F.max((F.col("_w") == "test").cast("int")).alias("_in_test"), F.max((F.col("_w") == "oot").cast("int")).alias("_in_oot"),
        F.count(F.lit(1)).alias("_rows"))
    known = seen.filter(" and ".join(f"{g} is not null" for g in cfg.groups))
    joined = spread_attach(w, known, list(cfg.groups), rows="_rows").fillna({"_in_test": 0, "_in_oot": 0})
    in_holdout = (F.col("_in_test") == 1) | (F.col("_in_oot") == 1)
    history = _by_shares(
        unit_bucket(cfg.groups, cfg.seed), [(r, cfg.share(r)) for r in ("train", "valid", "oos") if cfg.share(r) > 0])
    purged = F.lit("purged")
    role = (
        F.when(F.col("_w") == "test", F.lit("test"))
        .when(F.col("_w") == "oot", F.when(F.col("_in_test") == 1, purged).otherwise(F.lit("oot")))
        .when(F.lit(cfg.purge_history) & in_holdout, purged).otherwise(history))
    return joined.withColumn("role", role).drop("_w", "_in_test", "_in_oot")


def split(df: DataFrame, cfg: SplitConfig) -> DataFrame:
    """Add the ``role`` column in the configured mode."""
    mode = cfg.validate().resolved()
    if mode == "temporal":
        return temporal_roles(df, cfg)
    if mode == "group_temporal":
        return group_temporal_roles(df, cfg)
    return hash_roles(df, cfg)


# --- folds ------------------------------------------------------------------------

def hash_folds(df: DataFrame, cfg: SplitConfig) -> DataFrame:
    """One row per input row and repeat with its validation fold."""
    repeats = F.array(*[
        F.struct(
            F.lit(r).alias("repeat"),
            F.floor(unit_bucket(cfg.hash_columns(), cfg.seed + r * cfg.seed_stride) * cfg.n_folds).cast("int").alias("fold"))
        for r in range(cfg.repeats)
    ])
    return df.select("*", F.inline(repeats))


def temporal_folds(df: DataFrame, cfg: SplitConfig, purge: bool = False) -> DataFrame:
    """Expanding windows: per fold the rows used, marked ``train``, ``valid`` or ``purged``."""
    width = (1.0 - cfg.temporal_min_train) / cfg.n_folds
    points = {f"_q{i}": min(cfg.temporal_min_train + i * width, 1.0) for i in range(cfg.n_folds + 1)}
    cuts = time_cutoffs(df, cfg.time, points)
    t = F.col(cfg.time).cast("timestamp")
    options = F.array(*[
        F.struct(
            F.lit(i).alias("fold"),
            F.when(t.isNull() | (t <= F.col(f"_q{i}")), F.lit("train")).when(t <= F.col(f"_q{i + 1}"), F.lit("valid")).alias("part"))
        for i in range(cfg.n_folds)
    ])
    long = df.crossJoin(F.broadcast(cuts)).select(*df.columns, F.inline(options)).filter("part is not null")
    if not purge:
        return long
    keys = ["fold", *cfg.groups]
    held = long.groupBy(*keys).agg(F.max(F.when(F.col("part") == "valid", 1)).alias("_held"), F.count(F.lit(1)).alias("_rows"))
    known = held.filter(" and ".join(f"{g} is not null" for g in cfg.groups))
    marked = spread_attach(long, known, keys, rows="_rows")
    leak = (F.col("part") == "train") & F.col("_held").isNotNull()
    return marked.withColumn("part", F.when(leak, F.lit("purged")).otherwise(F.col("part"))).drop("_held")


# --- reports ------------------------------------------------------------------------

def split_statistics(df: DataFrame, by: Sequence[str], target: str, time: str | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Rows per class, time range and group count per role or fold, in one aggregate."""
    aggs = [
        F.count(F.lit(1)).alias("rows"), F.sum((F.col(target) == 1).cast("long")).alias("positives"),
        F.sum((F.col(target) == 0).cast("long")).alias("negatives"),
    ]
    if time:
        aggs += [F.min(time).alias("time_min"), F.max(time).alias("time_max")]
    if groups:
        aggs.append(F.countDistinct(*groups).alias("groups"))
    return df.groupBy(*by).agg(*aggs)


def group_overlap(df: DataFrame, groups: Sequence[str], roles: Sequence[str]) -> DataFrame:
    """Groups shared by each pair of roles: one row per group first, then a few sums."""
    sets = df.groupBy(*groups).agg(*[F.max((F.col("role") == r).cast("int")).alias(r) for r in roles])
    pairs = [(a, b) for i, a in enumerate(roles) for b in roles[i + 1:]]
    sums = sets.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("long").alias(f"{a}__{b}") for a, b in pairs])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left_role"), F.lit(b).alias("right_role"), F.col(f"{a}__{b}").alias("shared_groups")) for a, b in pairs])))


def row_accounting(source: DataFrame, assigned: DataFrame) -> DataFrame:
    """Input rows = assigned + purged; anything left over is reported."""
    inp = source.agg(F.count(F.lit(1)).alias("input_rows"))
    out = assigned.agg(
        F.coalesce(F.sum((F.col("role") != "purged").cast("long")), F.lit(0)).alias("assigned_rows"),
        F.coalesce(F.sum((F.col("role") == "purged").cast("long")), F.lit(0)).alias("purged_rows"))
    return inp.crossJoin(F.broadcast(out)).withColumn(
        "unaccounted_rows", F.col("input_rows") - F.col("assigned_rows") - F.col("purged_rows"))


def class_problems(statistics: DataFrame, by: Sequence[str], min_positives: int) -> DataFrame:
    """Parts with one class only or too few positives."""
    problem = F.when((F.col("positives") == 0) | (F.col("negatives") == 0), F.lit("ONE_CLASS")).when(
        F.col("positives") < min_positives, F.lit("FEW_POSITIVES"))
    return statistics.select(*by, "rows", "positives", problem.alias("problem")).filter("problem is not null")


def input_checks(df: DataFrame, target: str, positive: object, time: str | None, groups: Sequence[str]) -> DataFrame:
    """Null counts, class count and presence of the positive label in one pass."""
    null_group = F.lit(False)
    for g in groups:
        null_group = null_group | F.col(g).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(target).isNull().cast("long")).alias("target_nulls"),
        F.sum((F.col(time).isNull() if time else F.lit(False)).cast("long")).alias("time_nulls"),
        F.sum(null_group.cast("long")).alias("group_nulls"), F.countDistinct(target).alias("classes"),
        F.coalesce(F.sum((F.col(target) == positive).cast("long")), F.lit(0)).alias("positive_rows"))


def leakage(df: DataFrame, keys: Sequence[str], train_role: str = "train") -> DataFrame:
    """Distinct keys that the training role shares with each other role."""
    pairs = df.filter("role <> 'purged'").select(*keys, "role").dropna().distinct()
    train = pairs.filter(F.col("role") == train_role).select(*keys)
    return pairs.filter(F.col("role") != train_role).join(train, list(keys), "left_semi").groupBy("role").agg(
        F.count(F.lit(1)).alias("shared_keys"))


def schema_digest(df: DataFrame) -> str:
    return hashlib.sha256("\n".join(f"{n}:{t}" for n, t in df.dtypes).encode()).hexdigest()


def manifest(source: DataFrame, cfg: SplitConfig, assigned: DataFrame) -> DataFrame:
    """One JSON row: settings, row accounting, per-role statistics, schema digest."""
    stats = split_statistics(assigned, ["role"], cfg.target, cfg.time, cfg.groups)
    per_role = stats.agg(F.sort_array(F.collect_list(F.struct(*stats.columns))).alias("stats"))  # one row per role
    facts = literal_rows(
        source.sparkSession,
        [(cfg.resolved(), cfg.seed, schema_digest(source), ",".join(cfg.groups), cfg.time)],
        "mode string,seed int,schema_sha256 string,group_columns string,time_column string")
    row = facts.crossJoin(F.broadcast(row_accounting(source, assigned))).crossJoin(F.broadcast(per_role))
    fractions = F.create_map(*[F.lit(x) for kv in cfg.fractions.items() for x in kv])
    return row.withColumn("fractions", fractions).select(F.to_json(F.struct("*")).alias("manifest"))


def assert_rows(report: DataFrame, condition: str, message: str) -> None:
    """Fail when any row of a report meets the condition."""
    bad = report.filter(condition).take(5)
    if bad:
        raise ValueError(f"{message}: {[r.asDict() for r in bad]}")
