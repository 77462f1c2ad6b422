"""Operators against plain Python on fixtures where one group holds most of the rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelwarden.functions.hashing import digest
from modelwarden.operators import bootstrap, evaluate, measures, ordered, sampling, splits, trials
from modelwarden.operators.relate import key_closure

RNG = random.Random(5)
ROWS = [("hot" if RNG.random() < 0.7 else f"k{RNG.randrange(4)}", i, float(RNG.choice([0, 0, 0, 1, 5, RNG.randrange(900)]))) for i in range(1500)]


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(ROWS, "k string, i int, v double").repartition(5).persist()


def groups():
    out = {}
    for k, i, v in ROWS:
        out.setdefault(k, []).append((v, i))
    return out


def test_row_number_and_prefix_sums(skewed):
    b = ordered.balanced_buckets(skewed, ["k"], "v", side=4)
    got = ordered.prefix_sums(b, ["k"], "_b", [F.col("v"), F.col("i")], {"n": F.lit(1).cast("long"), "s": "v"}).collect()
    want = {}
    for k, rows in groups().items():
        total = 0.0
        for n, (v, i) in enumerate(sorted(rows), 1):
            total += v
            want[i] = (n, total)
    assert {r.i: (r.n, r.s) for r in got} == want


@pytest.mark.parametrize("rule", ["disc", "nearest", "linear"])
def test_quantiles(skewed, rule):
    q = {"a": 0.0, "b": 0.25, "c": 0.9, "d": 1.0}
    got = {r.k: r for r in ordered.exact_quantiles(skewed, ["k"], "v", q, rule=rule).collect()}
    for k, rows in groups().items():
        vs = sorted(v for v, _ in rows)
        n = len(vs)
        for name, f in q.items():
            if rule == "disc":
                want = vs[max(math.ceil(f * n - 1e-9), 1) - 1]
            elif rule == "nearest":
                want = vs[math.floor(f * (n - 1) + 0.5)]
            else:
                pos = f * (n - 1)
                lo = math.floor(pos + 1e-12)
                want = vs[lo] + (vs[min(lo + 1, n - 1)] - vs[lo]) * max(pos - lo, 0.0)
            assert got[k][name] == pytest.approx(want), (k, name)


def test_quantiles_of_many_values_stay_exact(spark):
    """Coarse sketch, so that most values lie outside the kept bracket."""
    rows = [("hot" if i % 3 else "b", (i * 7919) % 10007 / 8) for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: r for r in ordered.exact_quantiles(df, ["k"], "v", {"x": 0.31, "y": 0.5, "z": 0.999}, rule="nearest", accuracy=200).collect()}
    for k in ("hot", "b"):
        vs = sorted(v for g, v in rows if g == k)
        assert [got[k][c] for c in "xyz"] == [vs[math.floor(q * (len(vs) - 1) + 0.5)] for q in (0.31, 0.5, 0.999)]


def test_quantiles_read_their_input_twice(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_extendedprice")
    text = ordered.exact_quantiles(df, [], "l_extendedprice", {"a": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2


def test_running_and_following_over_one_long_group(skewed):
    b = ordered.balanced_buckets(skewed.withColumn("g", F.lit(1)), ["g"], "i", side=5)
    known = F.when(F.col("v") > 5, F.col("v"))
    got = {r.i: r for r in ordered.following(ordered.running(
        b, ["g"], "_b", [F.col("i")], {"top": ("max", F.col("v")), "low": ("min", known), "known": ("last", known), "n": ("sum", F.lit(1))}), ["g"], "_b", [F.col("i")], "v", "next").collect()}
    seen, last = [], None
    for n, (_, i, v) in enumerate(ROWS, 1):
        seen.append(v)
        last = v if v > 5 else last
        r = got[i]
        assert (r.top, r.low, r.known, r.n) == (max(seen), min((x for x in seen if x > 5), default=None), last, n)
        assert r.next == (ROWS[n][2] if n < len(ROWS) else None)


def test_plateau_of_one_long_search(spark):
    values = [RNG.random() ** 3 for _ in range(700)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, i int, v double").repartition(5)
    got = {r.i: r for r in measures.running_plateau(df, "k", "i", "v", 0.05, 3).collect()}
    best = [max(values[: i + 1]) for i in range(len(values))]
    for i in range(len(values)):
        gains = [best[j] - best[j - 1] for j in range(max(1, i - 2), i + 1)]
        assert got[i].best == best[i] and got[i].plateau == (len(gains) == 3 and max(gains) < 0.05)


def test_hot_key_is_dealt_to_many_tasks(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(6)
    side = df.groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("low"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = ordered.spread_attach(df, side, ["k"], "inner", rows="n", share=0.01)
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert joined.columns == ["k", "i", "low"] and sum(tasks) == 6000 and max(tasks) <= 2 * 6000 / 4
        assert {(r.k, r.i): r.low for r in joined.collect()} == {(k, i): (0 if k == "hot" else i) for k, i in rows}
        counted = ordered.spread_attach(df, side.drop("n"), ["k"])
        assert counted.filter("low is null").count() == 0 and counted.count() == 6000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_smallest_n_takes_exactly_the_quota(skewed, spark):
    tagged = skewed.withColumn("h", digest(["i"], "s"))
    hashes = {r.i: r.h for r in tagged.collect()}
    for want in (0, 1, 7, 300, 10_000):
        quota = skewed.select("k").distinct().withColumn("quota", F.lit(want).cast("long"))
        got = {}
        for r in ordered.smallest_n(tagged, ["k"], "h", [F.col("i")], quota).collect():
            got.setdefault(r.k, set()).add(r.i)
        for k, rows in groups().items():
            best = sorted((hashes[i], i) for _, i in rows)[:want]
            assert got.get(k, set()) == {i for _, i in best}


def test_lags_across_buckets(skewed):
    d = skewed.withColumns({"b": (F.col("i") / 3).cast("int"), "t": F.col("v").cast("string")})
    got = {r.i: (r.lag1, r.lag2) for r in ordered.bucketed_lags(d, ["k"], "b", ["i"], "t").collect()}
    for k, rows in groups().items():
        seq = sorted((i, str(v)) for v, i in rows)
        for n, (i, _) in enumerate(seq):
            assert got[i] == (seq[n - 1][1] if n > 0 else None, seq[n - 2][1] if n > 1 else None)


def test_ranking_metrics(spark):
    rows = [("c", RNG.randrange(2), round(RNG.random(), 2), float(RNG.randrange(1, 5))) for _ in range(400)]
    df = spark.createDataFrame(rows, "candidate string, y int, score double, weight double")
    pos = [(s, w) for _, y, s, w in rows if y == 1]
    neg = [(s, w) for _, y, s, w in rows if y == 0]
    won = sum(wp * wn * (1.0 if sp > sn else 0.5 if sp == sn else 0.0) for sp, wp in pos for sn, wn in neg)
    want = won / (sum(w for _, w in pos) * sum(w for _, w in neg))
    wide, bounded = evaluate.metrics(df, ["candidate"]).first(), evaluate.metrics(df, ["candidate"], bounded=True).first()
    assert wide.auc == pytest.approx(want) and bounded.auc == pytest.approx(want)
    assert wide.average_precision == pytest.approx(bounded.average_precision)
    chosen = evaluate.choose_threshold(df, ["candidate"], "max_f1").first()
    curve = evaluate.pr_curve(df, ["candidate"]).collect()
    assert chosen.tuning_f1 == pytest.approx(max(r.f1 for r in curve))
    at = evaluate.threshold_metrics(df, ["candidate"], spark.createDataFrame([("c", chosen.threshold)], "candidate string, threshold double")).first()
    assert (at.precision, at.recall) == (pytest.approx(chosen.tuning_precision), pytest.approx(chosen.tuning_recall))


def trial_rows(n):
    return [(i, "m", "search", [f"f{j}" for j in sorted(RNG.sample(range(8), RNG.randrange(1, 6)))], RNG.randrange(12) / 10, RNG.randrange(5) / 10, RNG.choice([0.0, 0.0, 0.2])) for i in range(n)]


TRIALS = "trial_id int, method string, fidelity string, features array<string>, valid_metric double, metric_std double, constraint_violation double"


def dominates(a, b):
    if a.constraint_violation != b.constraint_violation:
        return a.constraint_violation < b.constraint_violation
    x, y = (a.valid_metric, -a.n_features, -a.metric_std), (b.valid_metric, -b.n_features, -b.metric_std)
    return all(p >= q for p, q in zip(x, y)) and x != y


@pytest.fixture(scope="module")
def trial_frame(spark):
    return trials.with_key(spark.createDataFrame(trial_rows(160), TRIALS)).persist()


def test_three_objective_front_and_layers(trial_frame):
    rows = trial_frame.collect()
    left, want = list(rows), []
    for layer in (1, 2):
        front = [r for r in left if not any(dominates(o, r) for o in left)]
        want += [(r.trial_id, layer) for r in front]
        left = [r for r in left if r not in front]
    got = [(r.trial_id, r.layer) for r in trials.layers(trial_frame, 2, lambda d: d.persist()).collect()]
    assert sorted(got) == sorted(want)


def test_selection_takes_the_asked_number(trial_frame):
    got = trials.nsga_select(trial_frame, 25, lambda d: d.checkpoint())
    assert got.count() == 25
    rows = {r.trial_id: r for r in trial_frame.collect()}
    kept = {r.trial_id for r in got.collect()}
    last = max(r.layer for r in got.collect())
    inner = {r.trial_id for r in got.filter(F.col("layer") < last).collect()}
    assert not any(dominates(rows[a], rows[b]) for a in rows.keys() - kept for b in inner)


def test_two_objective_front(trial_frame):
    ok = [r for r in trial_frame.collect() if r.constraint_violation == 0]
    want = {r.trial_id for r in ok if not any(
        o.valid_metric >= r.valid_metric and o.n_features <= r.n_features and (o.valid_metric > r.valid_metric or o.n_features < r.n_features) for o in ok)}
    assert {r.trial_id for r in trials.pareto_two(trial_frame).collect()} == want


def test_jaccard_and_pairs(spark):
    runs = [["a", "b"], ["a", "b"], ["b", "c"], ["d"]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "fold int, features array<string>")
    js = [len(set(a) & set(b)) / len(set(a) | set(b)) for i, a in enumerate(runs) for b in runs[i + 1:]]
    got = trials.pairwise_jaccard(df).first()
    assert (got.runs, got.min_jaccard, got.max_jaccard) == (4, min(js), max(js))
    assert got.mean_jaccard == pytest.approx(sum(js) / len(js))
    pairs = {(r["first"], r["second"]): r["count"] for r in trials.pair_frequency(df).collect()}
    assert pairs == {("a", "b"): 2, ("b", "c"): 1}
    single = trials.pairwise_jaccard(df.limit(1)).first()
    assert single.mean_jaccard == 1.0


def cfg(mode, **kw):
    shares = {"train": 0.5, "valid": 0.2, "oot": 0.2, "test": 0.1} if "temporal" in mode else {"train": 0.6, "valid": 0.2, "oos": 0.2}
    return splits.SplitConfig(keys=("i",), target="y", fractions=shares, mode=mode, time="t" if "temporal" in mode else None,
                              groups=("k",) if "group" in mode else (), **kw)


@pytest.fixture(scope="module")
def rows_to_split(spark):
    rows = [(i, f"g{RNG.randrange(90)}", i % 3 == 0, RNG.randrange(1000) if i % 40 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, k string, b boolean, d int")
    return df.select("i", "k", F.col("b").cast("int").alias("y"), F.timestamp_seconds(F.col("d") * 86400).alias("t")).persist()


@pytest.mark.parametrize("mode", splits.MODES)
def test_split_accounts_for_every_row(rows_to_split, mode):
    out = splits.split(rows_to_split, cfg(mode))
    acc = splits.row_accounting(rows_to_split, out).first()
    assert acc.unaccounted_rows == 0 and out.filter("role is null").count() == 0
    if "group" in mode:
        roles = [r for r in splits.ROLES if cfg(mode).share(r) > 0]
        assert splits.group_overlap(out, ["k"], roles).agg(F.sum("shared_groups")).first()[0] == 0


def test_temporal_windows_are_ordered(rows_to_split):
    s = {r.role: r for r in splits.split_statistics(splits.split(rows_to_split, cfg("temporal")), ["role"], "y", "t").collect()}
    assert s["train"].time_max < s["valid"].time_min and s["valid"].time_max < s["oot"].time_min and s["oot"].time_max < s["test"].time_min


def test_folds(rows_to_split):
    c = cfg("group", n_folds=4, repeats=2)
    folds = splits.hash_folds(rows_to_split, c)
    assert folds.groupBy("repeat").count().filter("count <> 900").count() == 0
    assert folds.select("repeat", "k", "fold").distinct().groupBy("repeat", "k").count().filter("count > 1").count() == 0
    tf = splits.temporal_folds(rows_to_split, cfg("group_temporal", n_folds=3), purge=True)
    both = tf.filter("part <> 'purged'").select("fold", "k", "part").distinct().groupBy("fold", "k").count().filter("count > 1")
    assert both.count() == 0


def test_configuration_rules():
    assert splits.SplitConfig(keys=("i",), target="y", fractions={"train": 0.5, "valid": 0.5}).resolved() == "stratified"
    assert cfg("group_temporal").problems() == []
    bad = splits.SplitConfig(keys=(), target="y", fractions={"train": 0.9, "valid": 0.2, "oot": 0.1}, mode="group")
    assert len(bad.problems()) == 4
    with pytest.raises(ValueError):
        bad.validate()


def scored_rows(spark, n=1200):
    """A third of the rows in one cluster, tied scores, unequal weights."""
    rows = [(str(i), "c1", int(i % 4 == 0), ((i * 37) % 50 + 10 * (i % 4 == 0)) / 64.0, 1.0 + i % 3, "hot" if i % 3 == 0 else f"g{i // 5}") for i in range(n)]
    return spark.createDataFrame(rows, "row_id string, candidate string, y int, score double, weight double, grp string")


def draws_in_python(unit, replicates, seed):
    out = {}
    for r in range(replicates):
        u = int(hashlib.md5(f"{seed}|{r // 4}|{unit}".encode()).hexdigest()[8 * (r % 4): 8 * (r % 4) + 8], 16)
        out[r] = sum(u >= limit for limit in bootstrap.poisson_limits())
    return out


def auc_in_python(rows):
    pairs = sum(wp * wn * (sp > sn) + wp * wn * (sp == sn) / 2 for yp, sp, wp in rows if yp for yn, sn, wn in rows if not yn)
    return pairs / (sum(w for y, _, w in rows if y) * sum(w for y, _, w in rows if not y))


def test_poisson_draws():
    shares = np.diff([0, *bootstrap.poisson_limits()]) / 2**32
    assert shares[:3] == pytest.approx([math.exp(-1), math.exp(-1), math.exp(-1) / 2]) and sum(k * p for k, p in enumerate(shares)) == pytest.approx(1, abs=1e-8)


def test_row_bootstrap_equals_plain_python(spark):
    df = scored_rows(spark, 240)
    local = df.collect()
    times = {r.row_id: draws_in_python(r.row_id, 6, "x") for r in local}
    got = {r.replicate: r for r in bootstrap.row_bootstrap(df, "row_id", 6, "x").collect()}
    assert set(got) == set(range(6))
    for k, r in got.items():
        assert r.auc == pytest.approx(auc_in_python([(x.y, x.score, x.weight * times[x.row_id][k]) for x in local])) and r.auc_slack == 0
    base = {(r.replicate, r.y): r for r in bootstrap.class_draws(df, "row_id", 6, "x").collect()}
    for (k, y), r in base.items():
        assert r.rows == sum(x.y == y for x in local) and (k < 0 or r.drawn == sum(times[x.row_id][k] for x in local if x.y == y))
        assert r.weight * r.factor == pytest.approx(base[-1, y].weight)


def test_cluster_bootstrap_equals_plain_python(spark):
    df = scored_rows(spark)
    local = df.collect()
    stratum, times = {}, {}
    for x in local:
        stratum[x.grp] = max(stratum.get(x.grp, 0), x.y)
        times[x.grp] = times.get(x.grp) or draws_in_python(x.grp, 3, "c")
    for r in bootstrap.cluster_bootstrap(df, "grp", 3, "c").collect():
        factor = {s: sum(v == s for v in stratum.values()) / max(1, sum(times[g][r.replicate] for g in stratum if stratum[g] == s)) for s in (0, 1)}
        want = auc_in_python([(x.y, x.score, x.weight * times[x.grp][r.replicate] * factor[stratum[x.grp]]) for x in local])
        assert r.auc == pytest.approx(want)


def test_coarse_grid_states_what_it_hides(spark):
    df = scored_rows(spark)
    exact = {r.replicate: r.auc for r in bootstrap.row_bootstrap(df, "row_id", 2, "x").collect()}
    for r in bootstrap.row_bootstrap(df, "row_id", 2, "x", bins=16).collect():
        assert r.auc_slack > 0 and abs(r.auc - exact[r.replicate]) <= r.auc_slack + 1e-12


def test_bootstrap_refuses_too_few_units(spark):
    df = scored_rows(spark, 60)
    with pytest.raises(ValueError):
        bootstrap.row_bootstrap(df.filter("y = 0"), "row_id", 2, "x")
    with pytest.raises(ValueError):
        bootstrap.cluster_bootstrap(df.filter("grp in ('hot', 'g1')"), "grp", 2, "x")


def test_quota_control_matches(spark):
    df = spark.createDataFrame([(f"v{i}", "ABCDEX"[i % 6]) for i in range(205)], "id string, c string")
    kept = sampling.category_quota_sample(df, F.col("c"), ["id"], "s", "floor")
    rows = {r.category: r for r in sampling.quota_control(df, F.col("c"), kept, "floor").collect()}
    assert all(r.selected_count == r.expected_selected for r in rows.values())
    assert rows["A"].selected_count == rows["A"].operational_count and rows["E"].selected_count == 0
    assert rows["C"].selected_count == rows["C"].operational_count // 2


def test_closure(spark):
    ab = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "z")], "a string, b string")
    bc = spark.createDataFrame([("x", "p"), ("z", "q"), ("y", None)], "b string, c string")
    got = key_closure(spark.createDataFrame([("1",)], "a string"), [("a", ab, "a", "b", "b"), ("b", bc, "b", "c", "c")], "a")
    assert sorted((r.kind, r.key) for r in got.collect()) == [("a", "1"), ("b", "x"), ("b", "y"), ("c", "p")]
