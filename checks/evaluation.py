"""Weighted metrics, thresholds, bootstrap and trial statistics with their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import Registry
from modelwarden.operators import bootstrap as bo
from modelwarden.operators import evaluate as ev
from modelwarden.operators import measures as me
from modelwarden.operators import trials as tr
from pyspark.sql import functions as F

from .development import only
from .sqlkit import bucket, ctes, written

BY = ["candidate"]
REPLICATES = 24
RULE = dict(objective="max_precision", min_precision=0.30, min_recall=0.40)


def paired(spark, sf):
    """Every line of an order with the scores of three candidates; a line is positive when it was returned."""
    li = Registry.of(spark, sf).base("lineitem")
    row = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    h = F.md5(F.concat(F.lit("p:"), row))
    y = (F.col("l_returnflag") == "R").cast("int")
    base = li.select(row.alias("row_id"), y.alias("y"), F.col("l_quantity").alias("weight"), F.col("l_suppkey").alias("group_id"),
                     F.col("l_linestatus").alias("split"), h.alias("h"))
    cands = F.array(*[
        F.struct(F.lit(f"c{j}").alias("candidate"),
                 ((F.conv(F.substring("h", 1 + 3 * j, 3), 16, 10).cast("int") % 800 + F.col("y") * 60 * j + 20) / F.lit(1000.0)).alias("score"))
        for j in (1, 2, 3)])
    return base.select("row_id", "y", "weight", "group_id", "split", cands.alias("scores"))


def predictions(spark, sf):
    """The same, one row per line and candidate."""
    return bo.by_candidate(paired(spark, sf))


def r6(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def rows_of(p):
    return p.filter("candidate = 'c1'").drop("candidate", "score")


def q_base(s, f):
    return r6(bo.class_draws(rows_of(predictions(s, f)), "row_id", REPLICATES, "boot"))


def replicates(s, f):
    return bo.row_bootstrap(paired(s, f), "row_id", REPLICATES, "boot", hold=written)


def q_row_bootstrap(s, f):
    return r6(replicates(s, f))


def by_order(p):
    """Clusters are orders here, so that some hold no positive line."""
    return p.withColumn("group_id", F.split("row_id", "-")[0])


def q_cluster_base(s, f):
    return r6(bo.cluster_draws(bo.clusters_of(by_order(rows_of(predictions(s, f))), "group_id"), "group_id", REPLICATES, "cboot"))


def q_cluster_bootstrap(s, f):
    return r6(bo.cluster_bootstrap(by_order(paired(s, f)), "group_id", REPLICATES, "cboot", hold=written))


def points(s, f):
    return ev.metrics(predictions(s, f), BY, hold=written).select(
        "candidate", F.substring("candidate", 2, 1).cast("int").alias("n_features"), F.col("auc").alias("point"))


def intervals(s, f):
    """Points and replicates are read several times, so their few rows are written."""
    return bo.confidence(written(points(s, f)), written(replicates(s, f).select("replicate", "candidate", F.col("auc").alias("value"))), 0.9, 0.06)


def q_violation(s, f):
    m = ev.metrics(predictions(s, f), [*BY, "split"]).groupBy("candidate").agg(
        F.max(F.when(F.col("split") == "O", F.col("auc"))).alias("train_metric"), F.max(F.when(F.col("split") == "F", F.col("auc"))).alias("valid_metric"),
        F.max(F.when(F.col("split") == "O", F.col("gini"))).alias("train_gini"), F.max(F.when(F.col("split") == "F", F.col("gini"))).alias("valid_gini"))
    t = ev.choose_threshold(predictions(s, f), BY, **RULE)
    out = ev.constraint_violation(m.join(t, "candidate"), 0.001, 0.002, RULE["min_precision"], RULE["min_recall"])
    return r6(out.select("candidate", "gap", "gini_gap", "constraint_violation"))


def q_frozen(s, f):
    p = predictions(s, f)
    return r6(ev.frozen_threshold(p.filter("split = 'O'"), p.filter("split = 'F'"), BY, **RULE).drop("tuning_shortfall"))


def q_at(s, f):
    p = predictions(s, f)
    t = p.select("candidate").distinct().withColumn("threshold", F.lit(0.5))
    return r6(ev.threshold_metrics(p, BY, t))


# --- trials -----------------------------------------------------------------------

def trials(spark, sf, kinds=12):
    """One trial per order: its lines name the features out of `kinds`, digests give the measured values."""
    r = Registry.of(spark, sf)
    feats = r.base("lineitem").select("l_orderkey", F.concat(F.lit("f"), (F.col("l_partkey") % kinds).cast("string")).alias("f")).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("f")).alias("features"))
    h = F.md5(F.concat(F.lit("tr:"), F.col("o_orderkey").cast("string")))

    def slot(i):
        return F.conv(F.substring("h", 1 + 3 * i, 3), 16, 10).cast("int")

    o = r.base("orders").select("o_orderkey", "o_custkey", "o_orderstatus", h.alias("h"))
    return o.join(feats, o["o_orderkey"] == feats["l_orderkey"]).select(
        F.col("o_orderkey").alias("trial_id"), F.concat(F.lit("M_"), "o_orderstatus").alias("method"),
        F.when(slot(0) < 3000, "search").otherwise("confirm").alias("fidelity"), (F.col("o_custkey") % 25).cast("int").alias("fold"), "features",
        F.size("features").alias("n_features"), ((slot(1) % 1000) / F.lit(1000.0)).alias("valid_metric"), ((slot(2) % 50) / F.lit(1000.0)).alias("metric_std"),
        F.when(slot(3) < 3000, 0.0).otherwise((slot(3) % 7) / F.lit(100.0)).alias("constraint_violation"))


def keyed(s, f):
    return tr.with_key(trials(s, f))


def out(df, *cols):
    return r6(df.select("trial_id", "subset_key", "n_features", "valid_metric", "metric_std", "constraint_violation", *cols))


def search(s, f):
    return tr.best_per_subset(trials(s, f)).filter("fidelity = 'search'")


def folds(s, f):
    """Features that occur more often than average in the trials of a fold."""
    counts = trials(s, f).select("fold", F.explode("features").alias("f")).groupBy("fold", "f").agg(F.count(F.lit(1)).alias("n"))
    mean = counts.groupBy("fold").agg(F.avg("n").alias("m"))
    return counts.join(mean, "fold").filter("n > m").groupBy("fold").agg(F.array_sort(F.collect_list("f")).alias("features"))


def q_promotion(strategy):
    def run(s, f):
        return tr.promotion_size(search(s, f), strategy, 0.05, 3, 0.01, 0.4, 0.02)
    return run


def q_synergy(s, f):
    t = search(s, f)
    req = t.filter("n_features >= 3").select("features", F.col("features")[0].alias("first"), F.col("features")[1].alias("second")).distinct()
    return r6(tr.synergy(t, req))


def q_proposals(weighted):
    def run(s, f):
        t = trials(s, f)
        fr = tr.feature_frequency(tr.top_trials(keyed(s, f), 50), "weight")
        return tr.subspace_proposals(t.select(F.col("trial_id").alias("proposal")), fr, 2, 5, "prop", ("f3",), 0.1 if weighted else None).select(
            "subset_key", "n_features", "proposal")
    return run


def telemetry(s, f):
    e = Registry.of(s, f).base("events")
    return e.select(
        (F.col("user_id") % 9).alias("active_trials"), (F.col("event_id") % 5).alias("pending_trials"), (F.col("event_id") % 4).alias("allowed_trials"),
        F.col("value").alias("cpu_percent"), (F.col("value") / 8).alias("ram_available_gb"),
        F.array(*[F.struct(F.lit(d).alias("device"), (F.col("value") / (i + 2)).alias("free_gb")) for i, d in enumerate(("gpu0", "gpu1"))]).alias("gpus"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("termination_reason"), F.when(F.col("user_id") % 3 == 0, F.lit("MemoryError")).alias("error_type"),
        (F.col("user_id") % 3 == 0).alias("oom_detected"))


def q_plateau(s, f):
    steps = trials(s, f).filter("constraint_violation = 0").withColumn("search_id", F.floor(F.col("trial_id") / 40).cast("long"))
    return r6(me.running_plateau(steps.select("search_id", "trial_id", "valid_metric"), "search_id", "trial_id", "valid_metric", 0.01, 3))


QUERIES = {
    "eval_metrics": lambda s, f: r6(ev.metrics(predictions(s, f), BY)),
    "eval_metrics_by_split": lambda s, f: r6(ev.metrics(predictions(s, f), [*BY, "split"])),
    "eval_threshold_metrics": q_at,
    "eval_pr_curve": lambda s, f: r6(ev.pr_curve(predictions(s, f), BY)),
    "eval_choose_f1": lambda s, f: r6(ev.choose_threshold(predictions(s, f), BY, "max_f1", 0.9, 0.2)),
    "eval_frozen_threshold": q_frozen, "eval_constraint_violation": q_violation,
    "boot_class_base": q_base, "boot_cluster_base": q_cluster_base, "boot_rows": q_row_bootstrap, "boot_clusters": q_cluster_bootstrap,
    "boot_confidence": lambda s, f: r6(intervals(s, f)), "boot_winner": lambda s, f: r6(bo.winner(intervals(s, f), None, 0.06)),
    "trial_best_per_subset": lambda s, f: out(tr.best_per_subset(trials(s, f)), "fidelity"),
    "trial_pareto_two": lambda s, f: out(tr.pareto_two(search(s, f))),
    "trial_pareto_three": lambda s, f: out(tr.pareto_three(search(s, f))),
    "trial_layers": lambda s, f: out(tr.layers(search(s, f), 2), "layer"),
    "trial_crowding": lambda s, f: r6(tr.crowding(tr.layers(search(s, f), 2)).select("trial_id", "layer", "crowding")),
    "trial_promotion_fixed": q_promotion("fixed"), "trial_promotion_adaptive": q_promotion("adaptive"),
    "trial_coalitions": lambda s, f: r6(tr.coalitions(trials(s, f, 60), 0.2, 2.0, 5)),
    "trial_feature_frequency": lambda s, f: r6(tr.feature_frequency(tr.top_trials(keyed(s, f), 100))),
    "trial_pair_frequency": lambda s, f: r6(tr.pair_frequency(tr.top_trials(keyed(s, f), 100))),
    "fold_feature_stability": lambda s, f: r6(tr.feature_stability(folds(s, f), 0.5, 0.6, 8, 7, ("f1",))),
    "fold_stable_pairs": lambda s, f: r6(tr.stable_pairs(folds(s, f), 0.3, 20)),
    "fold_size_statistics": lambda s, f: r6(tr.size_statistics(folds(s, f))),
    "fold_jaccard": lambda s, f: r6(tr.pairwise_jaccard(folds(s, f))),
    "trial_compact": lambda s, f: out(tr.choose_compact(tr.pareto_three(search(s, f)), 0.3)),
    "trial_finalists": lambda s, f: out(tr.finalists(tr.pareto_three(search(s, f)), 8, 0.3)),
    "trial_synergy": q_synergy, "trial_size_frontier": lambda s, f: r6(tr.size_frontier(trials(s, f))),
    "trial_confirmation_summary": lambda s, f: r6(tr.confirmation_summary(tr.with_key(trials(s, f)).filter("fidelity = 'confirm'"))),
    "trial_top_sets": lambda s, f: r6(tr.top_sets(trials(s, f), 5).select("method", "rank", "subset_key", "valid_metric", "trial_id")),
    "trial_proposals_uniform": q_proposals(False), "trial_proposals_weighted": q_proposals(True),
    "trial_running_plateau": q_plateau,
    "run_resource_summary": lambda s, f: r6(tr.resource_summary(telemetry(s, f))),
    "run_device_minimum": lambda s, f: r6(tr.device_minimum(telemetry(s, f))),
    "run_failure_summary": lambda s, f: tr.failure_summary(telemetry(s, f)),
}


def hx(h, i):
    return f"cast(('0x' || substr({h}, {1 + 3 * i}, 3)) as integer)"


def auc_sql(src, by):
    """AUC, AP and losses from one row per distinct score."""
    b = ", ".join(by)
    return (f"select {b}, u / (p * n) auc, ap / p average_precision, p + n total_weight, ll / (p + n) logloss, -br / (p + n) brier from (select {b}, sum(pos) p, sum(neg) n, "
            f"sum(neg * (tp - pos + pos / 2)) u, sum(pos * tp / nullif(tp + fp, 0)) ap, sum(pos * ln(greatest(least(score, 1 - 1e-15), 1e-15)) + neg * ln(1 - greatest(least(score, 1 - 1e-15), 1e-15))) ll, "
            f"sum(pos * (1 - score) * (1 - score) + neg * score * score) br from (select *, sum(pos) over (partition by {b} order by score desc) tp, sum(neg) over (partition by {b} order by score desc) fp from "
            f"(select {b}, score, sum(case when y = 1 then weight else 0 end)::double pos, sum(case when y = 0 then weight else 0 end)::double neg from {src} group by {b}, score)) group by {b})")


def drawn_sql(units, key, seed):
    """Units with their Poisson multiplicities by replicate; -1 has each once."""
    times = " + ".join(f"(case when u >= {limit} then 1 else 0 end)" for limit in bo.poisson_limits() if limit < 1 << 32)
    draws = (f"select x.*, b * 4 + i replicate, ('0x' || substr(md5('{seed}|' || b || '|' || {key}), 1 + 8 * cast(i as integer), 8))::ubigint u from {units} x, range(0, {REPLICATES // 4}) b_(b), range(0, 4) i_(i)")
    return f"select *, -1 replicate, 1 times from {units} union all select * from (select * exclude (u), {times} times from ({draws})) where times > 0"


RANK = "constraint_violation, valid_metric desc, n_features, metric_std, trial_id"


@lru_cache(None)
def base_ctes():
    row = "cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar)"
    c = dict(
        lines=f"select *, {row} row_id, md5('p:' || {row}) h, cast(l_returnflag = 'R' as integer) y from lineitem",
        pr=" union all ".join(
            f"select row_id, y, l_quantity weight, l_suppkey group_id, l_linestatus split, 'c{j}' candidate, ({hx('h', j)} % 800 + y * 60 * {j} + 20) / 1000.0::double score from lines" for j in (1, 2, 3)),
        met=auc_sql("pr", ["candidate"]), mets=auc_sql("pr", ["candidate", "split"]),
        curve="select candidate, score threshold, tp / nullif(tp + fp, 0) precision, tp / p recall from (select *, sum(pos) over (partition by candidate order by score desc) tp, "
              "sum(neg) over (partition by candidate order by score desc) fp, sum(pos) over (partition by candidate) p from (select candidate, score, sum(case when y = 1 then weight else 0 end)::double pos, "
              "sum(case when y = 0 then weight else 0 end)::double neg from pr {w} group by 1, 2))",
        rows1="select row_id, y, weight, split_part(row_id, '-', 1) oid from pr where candidate = 'c1'",
        rt=drawn_sql("(select distinct row_id from rows1)", "row_id", "boot"), ct=drawn_sql("(select oid, count(*) size, max(y) stratum from rows1 group by 1)", "oid", "cboot"),
        cd="select replicate, y, sum(times) drawn, sum(weight * times)::double weight from rt join rows1 using (row_id) group by 1, 2",
        cd2="select c.replicate, y, w.drawn as rows, c.drawn, c.weight, w.weight / c.weight factor from cd c join (select * from cd where replicate = -1) w using (y)",
        sd="select replicate, stratum, sum(times) drawn, sum(size * times) as rows from ct group by 1, 2",
        sd2="select c.replicate, stratum, w.drawn clusters, c.drawn, c.rows, w.drawn / c.drawn factor from sd c join (select * from sd where replicate = -1) w using (stratum)",
        bs="select t.replicate, p.candidate, least(floor(p.score * 65536), 65535) score, p.y, p.weight * t.times * factor weight from rt t join pr p using (row_id) join cd2 on cd2.replicate = t.replicate and cd2.y = p.y where t.replicate >= 0",
        rep=auc_sql("bs", ["replicate", "candidate"]),
        cbs="select t.replicate, p.candidate, least(floor(p.score * 65536), 65535) score, p.y, p.weight * t.times * factor weight from ct t join (select *, split_part(row_id, '-', 1) oid from pr) p using (oid) "
            "join sd2 using (replicate, stratum) where t.replicate >= 0",
        crep=auc_sql("cbs", ["replicate", "candidate"]),
        pts="select candidate, cast(substr(candidate, 2, 1) as integer) n_features, auc point from met",
        best="select candidate reference, point ref_point from pts order by point desc, candidate limit 1",
        prs="select r.candidate, r.auc v, r.auc - q.auc d from rep r join (select replicate, auc from rep where candidate = (select reference from best)) q using (replicate)",
        ci="select p.candidate, n_features, point, point + quantile_cont(v, 0.05) - avg(v) ci_low, point + quantile_cont(v, 0.95) - avg(v) ci_high, stddev_samp(v) bootstrap_std, "
           "(select reference from best) reference, point - (select ref_point from best) delta, point - (select ref_point from best) + quantile_cont(d, 0.05) - avg(d) delta_ci_low, "
           "point - (select ref_point from best) + quantile_cont(d, 0.95) - avg(d) delta_ci_high from pts p join prs using (candidate) group by p.candidate, n_features, point",
        t="select o_orderkey trial_id, 'M_' || o_orderstatus as method, case when " + hx("h", 0) + " < 3000 then 'search' else 'confirm' end fidelity, cast(o_custkey % 25 as integer) fold, features, "
          "len(features) n_features, array_to_string(features, '|') subset_key, (" + hx("h", 1) + " % 1000) / 1000.0::double valid_metric, (" + hx("h", 2) + " % 50) / 1000.0::double metric_std, "
          "case when " + hx("h", 3) + " < 3000 then 0.0::double else (" + hx("h", 3) + " % 7) / 100.0::double end constraint_violation from (select *, md5('tr:' || cast(o_orderkey as varchar)) h from orders) "
          "join (select l_orderkey, list_sort(list(distinct 'f' || cast(l_partkey % 12 as varchar))) features from lineitem group by 1) on o_orderkey = l_orderkey",
        bst=f"select * from (select *, row_number() over (partition by fidelity, subset_key order by {RANK}) rn from t) where rn = 1",
        se="select * exclude (rn) from bst where fidelity = 'search'",
        topv="select * from se where constraint_violation = (select min(constraint_violation) from se)",
        tup="select distinct n_features n, valid_metric v, metric_std s from topv",
        f1="select * from topv p where not exists (select 1 from tup where n <= p.n_features and v >= p.valid_metric and s <= p.metric_std and (n < p.n_features or v > p.valid_metric or s < p.metric_std))",
        rest="select * from se where trial_id not in (select trial_id from f1)",
        topv2="select * from rest where constraint_violation = (select min(constraint_violation) from rest)",
        tup2="select distinct n_features n, valid_metric v, metric_std s from topv2",
        f2="select * from topv2 p where not exists (select 1 from tup2 where n <= p.n_features and v >= p.valid_metric and s <= p.metric_std and (n < p.n_features or v > p.valid_metric or s < p.metric_std))",
        ly="select *, 1 layer from f1 union all select *, 2 layer from f2",
        ok2="select * from se where constraint_violation <= 1e-12",
        best1=f"select * exclude (r_) from (select *, row_number() over (partition by subset_key order by {RANK}) r_ from t) where r_ = 1",
        ranked=f"select *, row_number() over (order by -(-constraint_violation * 1e6 + valid_metric), {RANK}) pos from best1",
        top100=f"select * from t order by {RANK} limit 100", top50=f"select * from t order by {RANK} limit 50",
        fc="select fold, f, count(*) n from (select fold, unnest(features) f from t) group by 1, 2",
        fo="select fold, list_sort(list(f)) features from fc join (select fold, avg(n) m from fc group by 1) using (fold) where n > m group by 1",
        ffq="select f feature, count(*) n from (select unnest(features) f from fo) group by 1",
        jac="select j from (select len(list_intersect(a.features, b.features)) / len(list_distinct(list_concat(a.features, b.features))) j from fo a join fo b on a.fold < b.fold)",
        cmp="select * from f1 where constraint_violation = 0 or not exists (select 1 from f1 where constraint_violation = 0)",
    )
    return c


def w(body, **more):
    names = {k: v.replace("{w}", "") for k, v in base_ctes().items()} | more
    return ctes(**only(names, body)) + body


def chosen(curve_where, objective, mp, mr):
    order = {"max_precision": "precision desc, recall desc, f1 desc", "max_f1": "f1 desc, precision desc, recall desc"}[objective]
    short = f"greatest({mp} - precision, 0) + greatest({mr} - recall, 0)"
    return (f"select candidate, threshold, precision, recall, f1, short from (select *, {short} short, row_number() over (partition by candidate order by {short}, {order}, threshold desc) r from "
            f"(select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) f1 from ({base_ctes()['curve'].replace('{w}', curve_where)}))) where r = 1")


def proposals_sql(weighted):
    fw = "0.1 + k / 50.0" if weighted else "1.0"
    return w(
        "select subset_key, len(fs) n_features, min(proposal) proposal from (select proposal, fs, array_to_string(fs, '|') subset_key from (select proposal, list_sort(list(feature)) fs from "
        "(select *, row_number() over (partition by proposal order by k2, feature) r from (select trial_id proposal, feature, 2 + "
        + bucket("'prop:size|' || cast(trial_id as varchar)") + " % 4 size, case when feature = 'f3' then -1.0 else -ln((" + bucket("'prop|' || cast(trial_id as varchar) || '|' || feature")
        + f" + 1) / 4294967297.0) / ({fw}) end k2 from t, (select f feature, count(*) k from (select unnest(features) f from top50) group by 1))) where r <= size group by 1)) group by 1, fs")


def ORACLE():
    import re

    return {k: re.sub(r'(?<![\w"])precision(?![\w"])', '"precision"', v) for k, v in _oracle().items()}


def _oracle():
    hit = "sum(case when {0} then weight else 0 end)"
    o = "trial_id, subset_key, n_features, valid_metric, metric_std, constraint_violation"
    ch = chosen("where split = 'O'", "max_precision", 0.30, 0.40)
    ch_all = chosen("", "max_precision", 0.30, 0.40)
    ch2 = chosen("", "max_f1", 0.9, 0.2)
    at = ("select candidate, p precision, r recall, coalesce(2 * p * r / nullif(p + r, 0), 0) f1, pr_rate from (select candidate, tp / nullif(tp + fp, 0) p, tp / nullif(tp + fn, 0) r, h / a pr_rate from "
          "(select candidate, " + hit.format("score >= {t} and y = 1") + " tp, " + hit.format("score >= {t} and y = 0") + " fp, " + hit.format("score < {t} and y = 1") + " fn, " + hit.format("score >= {t}")
          + " h, sum(weight) a from {src} group by 1))")
    combo2 = "select {0}, features[i] a, features[j] b from {1}, unnest(range(1, len(features) + 1)) x(i), unnest(range(i + 1, len(features) + 1)) y(j)"
    combo3 = "select {0}, features[i] || '|' || features[j] || '|' || features[k] members from {1}, unnest(range(1, len(features) + 1)) x(i), unnest(range(i + 1, len(features) + 1)) y(j), unnest(range(j + 1, len(features) + 1)) z(k)"
    coal = ("with_members as (" + "select subset_key, valid_metric, elite, a || '|' || b members, 2 ord from (" + combo2.format("subset_key, valid_metric, elite", "el") + ") union all select subset_key, valid_metric, elite, members, 3 from ("
            + combo3.format("subset_key, valid_metric, elite", "el") + "))")
    fs = "select *, case when pos <= greatest(1, ceil(n * 0.2 - 1e-9)) then 1 else 0 end elite from ranked, (select count(*) n from best1)"
    facts = "select count(*) n, avg(valid_metric) g, stddev_pop(valid_metric) sd, greatest(1, ceil(count(*) * 0.2 - 1e-9)) e from best1"
    coal_body = (
        "select members, ord \"order\", support, elite_support, round(lift, 6) lift, round(mean, 6) mean_metric, round(mean - g, 6) metric_gain, round(score, 6) score from "
        "(select *, greatest(0, lift + greatest(-5, least(5, (mean - g) / greatest(sd, 1e-12)))) * support / (support + 2.0) score from (select members, cast(ord as integer) ord, support, elite_support, g, sd, "
        "ln(((elite_support + 2.0) / (e + 4.0)) / ((support + 2.0) / (n + 4.0))) lift, (sm + 2.0 * g) / (support + 2.0) mean from (select members, ord, count(*) support, "
        "cast(sum(elite) as bigint) elite_support, sum(valid_metric) sm from with_members group by 1, 2), facts where support >= 5 and elite_support > 0)) where score > 0")
    promo_common = ("(select count(*) from se) screened, (select count(*) from f1) pareto_candidates, (select count(*) from near) near_best_candidates")
    near = "select * from se where constraint_violation = 0 and valid_metric >= (select max(valid_metric) from se where constraint_violation = 0) - 0.02"
    n_ = "(select count(*) from se)"
    lower = f"greatest(3, cast(ceil({n_} * 0.01 - 1e-9) as bigint))"
    amb = "(select count(distinct subset_key) from (select subset_key from f1 union select subset_key from near))"
    crowd = " + ".join(
        f"(case when lag({v}) over (partition by layer order by {v}, trial_id) is null or lead({v}) over (partition by layer order by {v}, trial_id) is null then 'inf'::double "
        f"when max({v}) over (partition by layer) > min({v}) over (partition by layer) then (lead({v}) over (partition by layer order by {v}, trial_id) - lag({v}) over (partition by layer order by {v}, trial_id)) "
        f"/ (max({v}) over (partition by layer) - min({v}) over (partition by layer)) else 0 end)" for v in ("valid_metric", "(-n_features)", "(-metric_std)"))
    fin = ("with_pos as (select *, row_number() over (order by n_features, valid_metric desc, trial_id) - 1 pos, count(*) over () - 1 last from f1), picks as ("
           "(select trial_id, 1 w from f1 order by valid_metric desc, trial_id limit 1) union all (select trial_id, 2 from f1 order by n_features, valid_metric desc, trial_id limit 1) union all "
           "(select trial_id, 3 from cmp where valid_metric >= (select max(valid_metric) from cmp) - 0.3 order by n_features, metric_std, valid_metric desc, trial_id limit 1) union all "
           "select trial_id, 4 from with_pos where pos in (select round_even(i * last / 4.0, 0) from with_pos, range(0, 5) r(i)) union all select trial_id, 5 from f1), bestw as (select trial_id, min(w) w from picks group by 1)")
    return {
        "eval_metrics": w("select candidate, round(auc, 6) auc, round(2 * auc - 1, 6) gini, round(average_precision, 6) average_precision, round(logloss, 6) logloss, round(brier, 6) brier, total_weight from met"),
        "eval_metrics_by_split": w("select candidate, split, round(auc, 6) auc, round(2 * auc - 1, 6) gini, round(average_precision, 6) average_precision, round(logloss, 6) logloss, round(brier, 6) brier, total_weight from mets"),
        "eval_threshold_metrics": w("select candidate, round(precision, 6) precision, round(recall, 6) recall, round(f1, 6) f1, round(pr_rate, 6) positive_rate from (" + at.format(t="0.5", src="pr") + ")"),
        "eval_pr_curve": w("select candidate, round(threshold, 6) threshold, round(precision, 6) precision, round(recall, 6) recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) f1 from curve"),
        "eval_choose_f1": w(f"select candidate, round(threshold, 6) threshold, round(precision, 6) tuning_precision, round(recall, 6) tuning_recall, round(f1, 6) tuning_f1, short <= 0 tuning_feasible, round(short, 6) tuning_shortfall from ({ch2})"),
        "eval_frozen_threshold": w(
            "select c.candidate, round(c.threshold, 6) threshold, round(c.precision, 6) tuning_precision, round(c.recall, 6) tuning_recall, round(c.f1, 6) tuning_f1, c.short <= 0 tuning_feasible, "
            "round(e.precision, 6) evaluation_precision, round(e.recall, 6) evaluation_recall, round(e.f1, 6) evaluation_f1, round(pr_rate, 6) positive_rate, e.precision >= 0.3 and e.recall >= 0.4 evaluation_feasible from ch c join ("
            + at.format(t="threshold", src="(select p.*, threshold from pr p join ch using (candidate) where split = 'F')") + ") e using (candidate)", ch=ch),
        "eval_constraint_violation": w(
            "select candidate, round(gap, 6) gap, round(gg, 6) gini_gap, round(greatest(0, gap - 0.001) + greatest(0, gg - 0.002) + short, 6) constraint_violation from (select candidate, "
            "greatest(0, max(auc) filter (split = 'O') - max(auc) filter (split = 'F')) gap, abs((2 * max(auc) filter (split = 'O') - 1) - (2 * max(auc) filter (split = 'F') - 1)) gg from mets group by 1) join ch using (candidate)", ch=ch_all),
        "boot_class_base": w("select cast(replicate as integer) replicate, y, cast(rows as bigint) as rows, cast(drawn as bigint) drawn, round(weight, 6) weight, round(factor, 6) factor from cd2"),
        "boot_cluster_base": w("select cast(replicate as integer) replicate, stratum, cast(clusters as bigint) clusters, cast(drawn as bigint) drawn, cast(rows as bigint) as rows, round(factor, 6) factor from sd2"),
        "boot_rows": w("select cast(replicate as integer) replicate, candidate, round(auc, 6) auc, round(average_precision, 6) average_precision, 0.0::double auc_slack from rep"),
        "boot_clusters": w("select cast(replicate as integer) replicate, candidate, round(auc, 6) auc, round(average_precision, 6) average_precision, 0.0::double auc_slack from crep"),
        "boot_confidence": w("select candidate, n_features, round(point, 6) point, round(ci_low, 6) ci_low, round(ci_high, 6) ci_high, round(bootstrap_std, 6) bootstrap_std, reference, round(delta, 6) delta, "
                             "round(delta_ci_low, 6) delta_ci_low, round(delta_ci_high, 6) delta_ci_high, delta_ci_low >= -0.06 noninferior from ci"),
        "boot_winner": w("select candidate, n_features, round(point, 6) point, round(ci_low, 6) ci_low, round(ci_high, 6) ci_high, round(bootstrap_std, 6) bootstrap_std, reference, round(delta, 6) delta, "
                         "round(delta_ci_low, 6) delta_ci_low, round(delta_ci_high, 6) delta_ci_high, noninferior from (select *, noninferior and ci_low >= (select max(ci_low) from cn) - 0.06 good from cn) "
                         "order by good desc, case when good then n_features end, ci_low desc, point desc limit 1", cn="select *, delta_ci_low >= -0.06 noninferior from ci"),
        "trial_best_per_subset": w(f"select {o}, fidelity from bst"),
        "trial_pareto_two": w(f"select {o} from ok2 p where not exists (select 1 from (select n_features n, max(valid_metric) v from ok2 group by 1) where n <= p.n_features and v >= p.valid_metric and (n < p.n_features or v > p.valid_metric))"),
        "trial_pareto_three": w(f"select {o} from f1"), "trial_layers": w(f"select {o}, layer from ly"),
        "trial_crowding": w(f"select trial_id, layer, round({crowd}, 6) crowding from ly"),
        "trial_promotion_fixed": w(f"select {promo_common}, least({n_}, greatest(3, cast(ceil({n_} * 0.05 - 1e-9) as bigint))) promoted", near=near),
        "trial_promotion_adaptive": w(f"select {promo_common}, least({n_}, least(greatest({lower}, cast(ceil({n_} * 0.4 - 1e-9) as bigint)), greatest({lower}, {amb}))) promoted", near=near),
        "trial_coalitions": w(coal_body, t=base_ctes()["t"].replace("l_partkey % 12", "l_partkey % 60"), el=fs, facts=facts, with_members=coal[len("with_members as ("):-1]),
        "trial_feature_frequency": w("select f feature, count(*) count, round(count(*) / 100.0, 6) frequency from (select unnest(features) f from top100) group by 1"),
        "trial_pair_frequency": w("select a \"first\", b \"second\", count(*) count, round(count(*) / 100.0, 6) frequency from (" + combo2.format("trial_id", "top100") + ") group by 1, 2"),
        "fold_feature_stability": w(
            "select feature, n count, round(n / runs, 6) frequency, cast(r as integer) rank, n >= greatest(1, ceil(0.6 * runs - 1e-12)) stable_core, (n >= greatest(1, ceil(0.5 * runs - 1e-12)) and r <= 8) or feature = 'f1' or r <= 7 candidate_pool "
            "from (select feature, n, runs, row_number() over (order by n desc, feature) r from (select feature, sum(n)::bigint n from (select * from ffq union all select 'f1', 0) group by 1), (select count(*) runs from fo))"),
        "fold_stable_pairs": w("select a \"first\", b \"second\", n count, round(n / runs, 6) frequency from (select a, b, count(*) n from (" + combo2.format("fold", "fo") + ") group by 1, 2), "
                               "(select count(*) runs from fo) where n >= greatest(1, ceil(0.3 * runs - 1e-12)) order by n desc, a, b limit 20"),
        "fold_size_statistics": w("select count(*) runs, cast(min(len(features)) as integer) min_size, cast(max(len(features)) as integer) max_size, round(avg(len(features)), 6) mean_size from fo"),
        "fold_jaccard": w("select (select count(*) from fo) runs, round(min(j), 6) min_jaccard, round(avg(j), 6) mean_jaccard, round(max(j), 6) max_jaccard from jac"),
        "trial_compact": w(f"select {o} from cmp where valid_metric >= (select max(valid_metric) from cmp) - 0.3 order by n_features, metric_std, valid_metric desc, trial_id limit 1"),
        "trial_finalists": ctes(**only({k: v.replace('{w}', '') for k, v in base_ctes().items()}, "f1 cmp")).rstrip() + ", " + fin
                           + f" select {o} from f1 join bestw using (trial_id) order by w, valid_metric desc, trial_id limit 8",
        "trial_synergy": w(
            "select p.subset_key, p.f1_ \"first\", p.f2_ \"second\", p.bs background_size, round(b.q, 6) score_background, round(a.q, 6) score_first, round(s.q, 6) score_second, round(x.q, 6) score_pair, round(x.q - a.q - s.q + b.q, 6) synergy from "
            "(select distinct subset_key, features[1] f1_, features[2] f2_, cast(len(features) - 2 as integer) bs, array_to_string(features[3:], '|') kb, array_to_string(list_sort(list_concat([features[1]], features[3:])), '|') ka, "
            "array_to_string(list_sort(list_concat([features[2]], features[3:])), '|') ks from se where len(features) >= 3) p join sq x on x.k = p.subset_key join sq b on b.k = p.kb join sq a on a.k = p.ka join sq s on s.k = p.ks",
            sq="select subset_key k, max(valid_metric) q from se group by 1"),
        "trial_size_frontier": w("select cast(n_features as integer) n_features, max(valid_metric) best_metric from t group by 1"),
        "trial_confirmation_summary": w(
            "select r.method, n runs, round(mm, 6) metric_mean, round(sd, 6) metric_std, round(nf, 6) n_features_mean, round(j, 6) mean_jaccard from (select method, count(*) n, avg(valid_metric) mm, stddev_samp(valid_metric) sd, avg(n_features) nf from cf group by 1) r join "
            "(select a.method, sum(case when a.k = b.k then 1.0 else len(list_intersect(a.fs, b.fs)) / len(list_distinct(list_concat(a.fs, b.fs))) end * case when a.k = b.k then a.n * (a.n - 1) / 2 else a.n * b.n end) "
            "/ sum(case when a.k = b.k then a.n * (a.n - 1) / 2 else a.n * b.n end) j from cg a join cg b on a.method = b.method and a.k <= b.k group by 1) j on j.method = r.method",
            cf="select method, valid_metric, n_features, features fs, subset_key k from t where fidelity = 'confirm'", cg="select method, k, fs, count(*) n from cf group by 1, 2, 3"),
        "trial_top_sets": w("select method, cast(rank as integer) rank, subset_key, valid_metric, trial_id from (select *, row_number() over (partition by method order by valid_metric desc, subset_key) rank from "
                            "(select *, row_number() over (partition by method, subset_key order by valid_metric desc, trial_id) z from t) where z = 1) where rank <= 5"),
        "trial_proposals_uniform": proposals_sql(False), "trial_proposals_weighted": proposals_sql(True),
        "trial_running_plateau": w(
            "select search_id, trial_id, valid_metric, best, round(gain, 6) gain, coalesce(count(gain) over w3 = 3 and max(gain) over w3 < 0.01, false) plateau from (select *, best - lag(best) over (partition by search_id order by trial_id) gain from "
            "(select cast(trial_id // 40 as bigint) search_id, trial_id, valid_metric, max(valid_metric) over (partition by trial_id // 40 order by trial_id) best from t where constraint_violation = 0)) window w3 as "
            "(partition by search_id order by trial_id rows between 2 preceding and current row)"),
        "run_resource_summary": "select count(*) observations, max(user_id % 9) max_active_trials, max(event_id % 5) max_pending_trials, max(value) max_cpu_percent, round(min(value / 8), 6) min_ram_available_gb, "
                                "count(*) filter (event_id % 4 = 0 and event_id % 5 > 0) zero_allowed_with_pending from events",
        "run_device_minimum": "select 'gpu0' device, round(min(value / 2), 6) min_free_gb from events union all select 'gpu1', round(min(value / 3), 6) from events",
        "run_failure_summary": "select case when event_type = 'view' then 'none' else event_type end termination_reason, case when user_id % 3 = 0 then 'MemoryError' else 'unknown' end error_type, count(*) trials, "
                               "count(*) filter (user_id % 3 = 0) oom_trials from events group by 1, 2",
    }
