"""Sampling, splits, folds, feature preparation and drift with their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import Registry
from modelwarden.functions.dates import expand_datetime
from modelwarden.operators import drift as dr
from modelwarden.operators import features as fe
from modelwarden.operators import sampling as sa
from modelwarden.operators import splits as sp
from modelwarden.operators.measures import entity_features
from pyspark.sql import functions as F

from .development import only
from .sqlkit import bucket, ctes, current, plain, truth, ts

SEED = 42
SHARES = {"train": 0.5, "valid": 0.2, "oos": 0.2, "test": 0.1}
LATE = {"train": 0.5, "valid": 0.15, "oos": 0.1, "oot": 0.15, "test": 0.1}
NUM, CAT = ("o_totalprice", "c_acctbal", "qty"), ("c_mktsegment", "o_orderstatus", "grade")


def base(spark, sf, name):
    return Registry.of(spark, sf).base(name)


def modelling(spark, sf):
    o, c = base(spark, sf, "orders"), base(spark, sf, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate")).alias("t"),
        (F.col("o_orderpriority") < "3").cast("int").alias("y"), "o_totalprice", "c_acctbal",
        F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_orderkey") % 7).cast("double")).alias("qty"),
        "c_mktsegment", "o_orderstatus", F.when(F.col("o_orderkey") % 13 != 0, F.substring("o_orderpriority", 1, 1)).alias("grade"))


M = ("select o_orderkey, o_custkey, case when o_orderkey % 97 <> 0 then o_orderdate end t, cast(o_orderpriority < '3' as integer) y, o_totalprice, c_acctbal, "
     "case when o_orderkey % 11 <> 0 then cast(o_orderkey % 7 as double) end qty, c_mktsegment, o_orderstatus, case when o_orderkey % 13 <> 0 then "
     "substr(o_orderpriority, 1, 1) end grade from orders join customer on o_custkey = c_custkey")


def u(expr, seed=SEED):
    return f"({bucket(f'{chr(39)}{seed}|{chr(39)} || {expr}')} / 4294967296.0)"


KEY = "cast(o_orderkey as varchar)"
GRP = "cast(o_custkey as varchar)"


def shares_sql(x, shares):
    total, upper, out = sum(s for _, s in shares), 0.0, "case "
    for r, s in shares[:-1]:
        upper += s / total
        out += f"when {x} < {upper!r}::double then '{r}' "
    return out + f"else '{shares[-1][0]}' end"


def cfg(mode, **kw):
    shares = kw.pop("fractions", LATE if "temporal" in mode else SHARES)
    return sp.SplitConfig(keys=("o_orderkey",), target="y", fractions=shares, mode=mode, time="t" if "temporal" in mode else None,
                          groups=("o_custkey",) if "group" in mode else (), seed=SEED, **kw)


def roles(mode):
    return lambda s, f: sp.split(modelling(s, f), cfg(mode)).select("o_orderkey", "role")


def grouped(s, f):
    return sp.split(modelling(s, f), cfg("group"))


def late(s, f):
    return sp.split(modelling(s, f), cfg("group_temporal"))


def q_time_cutoffs(s, f):
    return plain(sp.time_cutoffs(modelling(s, f), "t", {"half": 0.5, "late": 0.75, "last": 0.9}))


def q_temporal_folds(s, f):
    return sp.temporal_folds(modelling(s, f), cfg("temporal", n_folds=3)).select("o_orderkey", "fold", "part")


def q_temporal_folds_purged(s, f):
    return sp.temporal_folds(modelling(s, f), cfg("group_temporal", n_folds=3), purge=True).groupBy("fold", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("o_custkey").alias("groups"))


def q_hash_folds(s, f):
    return sp.hash_folds(modelling(s, f), cfg("stratified", n_folds=4, repeats=2)).select("o_orderkey", "repeat", "fold")


STAGES = {"screen_train": ("train", 0.3, 0.1), "search_train": ("train", 0.8, 0.4), "search_valid": ("valid", 1.0, 0.5), "oos": ("oos", 1.0, 0.7)}


def q_staged(s, f):
    d = sp.split(modelling(s, f), cfg("random"))
    return sa.staged_samples(d, "role", ["o_orderkey"], F.col("y") == 1, STAGES, "stage").select(
        "o_orderkey", "stage", F.round("selection_weight", 6).alias("selection_weight"))


def operational(s, f):
    return Registry.of(s, f).current("model_ver").select("model_ver_sid", "model_ver_signfcnt_ctgry_code")


def sig():
    return F.upper(F.trim("model_ver_signfcnt_ctgry_code"))


def q_quota(s, f):
    return sa.category_quota_sample(operational(s, f), sig(), ["model_ver_sid"], "quota", "ceil").select("model_ver_sid", "category")


def q_quota_control(s, f):
    d = operational(s, f)
    return sa.quota_control(d, sig(), sa.category_quota_sample(d, sig(), ["model_ver_sid"], "quota", "floor"), "floor")


def cases():
    from modelwarden.functions.predicates import blank
    from modelwarden.functions.predicates import truth as t

    return {"AUTO_ON": t("model_ver_montrg_auto_flag"), "NO_REPORT": blank("model_ver_dev_report_sid"),
            "PREVALIDATED_EMPTY": t("model_ver_prevalid_flag") & blank("model_ver_prevalid_rslt_name")}


def diagnostic(s, f):
    return sa.case_sample(Registry.of(s, f).current("model_ver"), "model_ver_sid", cases(), 5, "model_ver_signfcnt_ctgry_code", 3, 10, "diag")


def q_related(s, f):
    r = Registry.of(s, f)
    return sa.related_rows({
        "t_valid": (r.raw("valid"), "model_ver_sid"), "t_sample_data": (r.raw("sample_data"), "model_ver_sid"),
        "t_model_ver": (r.raw("model_ver"), "model_ver_sid"), "t_ent_param_chg": (r.raw("ent_param_chg"), "ent_sid")}, diagnostic(s, f), "model_ver_sid")


def q_features_ts(s, f):
    return expand_datetime(modelling(s, f).select("o_orderkey", "t"), ["t"])


def q_infinite(s, f):
    d = modelling(s, f).select("o_orderkey", F.try_divide(F.col("o_totalprice"), F.lit(1.0)).alias("a"),
                               F.when(F.col("o_orderkey") % 9 == 0, F.lit(float("inf"))).when(F.col("o_orderkey") % 9 == 1, F.lit(float("-inf")))
                               .otherwise(F.col("c_acctbal")).alias("b"))
    return fe.clean_infinite(d)


def q_constant(s, f):
    d = modelling(s, f).withColumns({"one": F.lit(1), "half": F.when(F.col("o_orderkey") % 2 == 0, F.lit("x")), "none": F.lit(None).cast("string")})
    return fe.constant_features(d, ["one", "half", "none", "c_mktsegment", "o_totalprice"])


def q_dates(s, f):
    d = modelling(s, f).select(
        F.date_format("t", "yyyy-MM-dd").alias("iso"), F.date_format("t", "dd.MM.yyyy").alias("local"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("n/a")).otherwise(F.date_format("t", "yyyy-MM-dd")).alias("mixed"), "c_mktsegment")
    return fe.date_text_rates(d, d.columns).select("column_name", "values", F.round("pattern_rate", 6).alias("pattern_rate"),
                                                   F.round("parse_rate", 6).alias("parse_rate"), "is_date")


def q_universe(s, f):
    d = modelling(s, f)
    names = fe.feature_universe(d, ["y", "o_orderkey", "o_custkey", "t"], required=["qty"], categorical=["grade"])
    cats = set(fe.infer_categorical(d, names))
    return d.agg(*[F.count(c).alias(c) for c in names]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(c in cats).alias("categorical"), F.col(c).alias("filled")) for c in names])))


def q_type_audit(s, f):
    d = sp.split(modelling(s, f), cfg("random"))
    parts = {r: d.filter(F.col("role") == r) for r in ("train", "valid", "oos")}
    return fe.type_audit(parts, [c for c in d.columns if c not in ("role", "y")])


def q_agreement(s, f):
    d = modelling(s, f)
    return fe.column_agreement({"train": d, "valid": d.withColumn("qty", F.col("qty").cast("int")), "oos": d.drop("grade")})


def drift_frame(s, f):
    return sp.split(modelling(s, f), cfg("random", fractions={"train": 0.5, "valid": 0.25, "oos": 0.25}))


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_manifest(s, f):
    """What the manifest states, one row per role."""
    text = sp.manifest(modelling(s, f), cfg("group_temporal"), late(s, f))
    shape = ("mode string, seed int, group_columns string, time_column string, input_rows bigint, assigned_rows bigint, purged_rows bigint, unaccounted_rows bigint, "
             "stats array<struct<role:string,rows:bigint,positives:bigint,negatives:bigint,groups:bigint>>")
    return text.select(F.from_json("manifest", shape).alias("m")).select("m.*").select(
        "mode", "group_columns", "time_column", "input_rows", "assigned_rows", "purged_rows", "unaccounted_rows", F.inline("stats"))


def auto(time, groups):
    return sp.SplitConfig(keys=("o_orderkey",), target="y", fractions=LATE if time else SHARES, time="t" if time else None, groups=("o_custkey",) if groups else (), seed=SEED)


def q_auto(s, f):
    """Roles under the mode that the configuration implies, for all four combinations of time and groups."""
    found = None
    for time in (False, True):
        for groups in (False, True):
            c = auto(time, groups)
            part = sp.split(modelling(s, f), c).groupBy("role").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(c.resolved()).alias("mode"), "role", "rows")
            found = part if found is None else found.unionByName(part)
    return found


def q_rules(s, f):
    """Configurations tried on the table: usable ones with their rows per role, others with what is wrong."""
    trials = {
        "no_train": auto(False, False).__class__(keys=("o_orderkey",), target="y", fractions={"train": 0.0, "valid": 1.0 - 1e-9}, mode="random"),
        "sum": sp.SplitConfig(keys=("o_orderkey",), target="y", fractions={"train": 0.5, "valid": 0.2}, mode="random"),
        "oot_without_time": sp.SplitConfig(keys=("o_orderkey",), target="y", fractions={"train": 0.5, "valid": 0.3, "oot": 0.2}, mode="random"),
        "group_without_columns": sp.SplitConfig(keys=("o_orderkey",), target="y", fractions=SHARES, mode="group"), "sound": cfg("random"),
    }
    found = None
    for name, c in trials.items():
        bad = c.problems()
        rows = sp.split(modelling(s, f), c).groupBy("role") if not bad else modelling(s, f).groupBy(F.lit(None).cast("string").alias("role"))
        part = rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("configuration"), F.lit("; ".join(bad)).alias("problems"), "role", "rows")
        found = part if found is None else found.unionByName(part)
    return found


QUERIES = {
    "split_auto": q_auto, "split_config_rules": q_rules,
    "split_random": roles("random"), "split_stratified": roles("stratified"), "split_group": roles("group"),
    "split_temporal": roles("temporal"), "split_group_temporal": roles("group_temporal"), "split_time_cutoffs": q_time_cutoffs,
    "split_statistics": lambda s, f: plain(sp.split_statistics(late(s, f), ["role"], "y", "t", ["o_custkey"])),
    "split_group_overlap": lambda s, f: sp.group_overlap(late(s, f), ["o_custkey"], ["train", "valid", "oos", "oot", "test"]),
    "split_row_accounting": lambda s, f: sp.row_accounting(modelling(s, f), late(s, f)),
    "split_class_problems": lambda s, f: sp.class_problems(sp.split_statistics(late(s, f), ["role"], "y"), ["role"], 600),
    "split_input_checks": lambda s, f: sp.input_checks(modelling(s, f), "y", 1, "t", ["o_custkey"]),
    "split_leakage": lambda s, f: sp.leakage(sp.split(modelling(s, f), cfg("random")), ["o_custkey"]),
    "split_manifest": q_manifest,
    "fold_hash": q_hash_folds, "fold_temporal": q_temporal_folds, "fold_temporal_purged": q_temporal_folds_purged,
    "sample_class_hash": lambda s, f: rounded(sa.class_hash_sample(modelling(s, f), ["o_orderkey"], F.col("y") == 1, 0.7, 0.2, SEED).select(
        "o_orderkey", "y", "selection_weight")),
    "sample_staged": q_staged,
    "sample_fixed_size": lambda s, f: sa.fixed_size_sample(modelling(s, f), "y", 1000, ["o_orderkey"], SEED).select("o_orderkey", "y"),
    "sample_category_quota": q_quota, "sample_quota_control": q_quota_control,
    "sample_cases": lambda s, f: diagnostic(s, f).select("model_ver_sid", "sample_reason"), "sample_related_rows": q_related,
    "sample_bernoulli": lambda s, f: sa.bernoulli_sample(base(s, f, "lineitem"), ["l_orderkey", "l_linenumber"], 1000).select("l_orderkey", "l_linenumber"),
    "feature_datetime": q_features_ts, "feature_clean_infinite": q_infinite, "feature_constant": q_constant, "feature_date_text": q_dates,
    "feature_universe": q_universe,
    "feature_fill_categorical": lambda s, f: fe.fill_categorical(modelling(s, f), ["grade", "c_mktsegment"]).select("o_orderkey", "grade", "c_mktsegment"),
    "feature_categorical_nulls": lambda s, f: fe.categorical_nulls(modelling(s, f), list(CAT)),
    "feature_binary_target": lambda s, f: fe.binary_target(modelling(s, f).withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "F").otherwise("open")), "o_orderstatus", "F").groupBy("o_orderstatus", "y").agg(
        F.count(F.lit(1)).alias("rows")),
    "feature_entity_aggregates": lambda s, f: rounded(entity_features(modelling(s, f).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"),
                                                                      "o_custkey", "o_totalprice", "o_orderstatus")),
    "drift_psi_numeric": lambda s, f: rounded(dr.psi_numeric(drift_frame(s, f), "role", NUM, "train", ["valid", "oos"])),
    "drift_psi_categorical": lambda s, f: rounded(dr.psi_categorical(drift_frame(s, f), "role", CAT, "train", ["valid", "oos"])),
    "drift_report": lambda s, f: rounded(dr.drift_report(drift_frame(s, f), "role", NUM, CAT, "train", ["valid", "oos"])),
}


@lru_cache(None)
def base_ctes():
    sh = list(SHARES.items())
    final = LATE["oot"] + LATE["test"]
    c = dict(
        m=M,
        tr="select t, row_number() over (order by t) - 1 i, count(*) over () n from m where t is not null",
        role_random=f"select *, {shares_sql(u(KEY), sh)} role from m",
        role_group=f"select *, {shares_sql(u(GRP), sh)} role from m",
        role_strat=f"select *, {shares_sql(u(KEY + ' || ' + chr(39) + '|' + chr(39) + ' || cast(y as varchar)'), sh)} role from m",
    )

    def cut(q):
        return f"(select min(t) from tr where i = cast(floor({q!r}::double * (n - 1) + 0.5) as bigint))"

    order = ["train", "valid", "oos", "oot", "test"]
    cum, expr = 0.0, "case when t is null then 'train' "
    for r in order[:-1]:
        cum += LATE[r]
        expr += f"when t <= {cut(cum)} then '{r}' "
    c["role_temporal"] = f"select *, {expr} else 'test' end role from m"
    c["win"] = f"select *, case when t is null or t <= {cut(1.0 - final)} then 'history' when t <= {cut(1.0 - LATE['test'])} then 'oot' else 'test' end w from m"
    c["seen"] = "select o_custkey g, bool_or(w = 'test') it, bool_or(w = 'oot') io from win group by 1"
    hist = shares_sql(u(GRP), [(r, LATE[r]) for r in ("train", "valid", "oos")])
    c["role_gt"] = (f"select win.*, case when w = 'test' then 'test' when w = 'oot' then case when it then 'purged' else 'oot' end when it or io then 'purged' else {hist} end role "
                    "from win join seen on g = o_custkey")
    c["cuts"] = f"select {cut(0.5)} half, {cut(0.75)} late, {cut(0.9)} \"last\""
    qs = [0.5 + i * (0.5 / 3) for i in range(4)]
    parts = " union all ".join(
        f"select m.*, {i} fold, case when t is null or t <= {cut(min(qs[i], 1.0))} then 'train' when t <= {cut(min(qs[i + 1], 1.0))} then 'valid' end part from m" for i in range(3))
    c["tf"] = f"select * from ({parts}) where part is not null"
    c["held"] = "select distinct fold, o_custkey from tf where part = 'valid'"
    c["tfp"] = "select tf.*, case when part = 'train' and (fold, o_custkey) in (from held) then 'purged' else part end p2 from tf"
    c["mv"] = current("model_ver")
    c["cat"] = ("select model_ver_sid, upper(trim(model_ver_signfcnt_ctgry_code)) category, row_number() over (partition by upper(trim(model_ver_signfcnt_ctgry_code)) order by "
                "md5('quota|' || model_ver_sid), model_ver_sid) r, count(*) over (partition by upper(trim(model_ver_signfcnt_ctgry_code))) n from mv")
    tr3 = shares_sql(u(KEY), [("train", 0.5), ("valid", 0.25), ("oos", 0.25)])
    c["df"] = f"select *, {tr3} role from m"
    num = ", ".join(f"{{'f': '{x}', 'v': cast({x} as double)}}" for x in NUM)
    cat = ", ".join(f"{{'f': '{x}', 'v': coalesce({x}, '__MISSING__')}}" for x in CAT)
    c["nl"] = f"select role, x.f feature, x.v v from (select role, unnest([{num}]) x from df) where x.v is not null"
    edges = "[" + ", ".join(f"quantile_cont(v, {i / 10!r})" for i in range(11)) + "]"
    c["ed"] = f"select feature, list_sort(list_distinct({edges})) e from nl where role = 'train' group by 1"
    c["nb"] = "select feature, role, len(list_filter(e[2:len(e) - 1], lambda z: z < v)) b, count(*) k from nl join ed using (feature) where len(e) >= 3 group by all"
    c["cl"] = f"select role, x.f feature, x.v b from (select role, unnest([{cat}]) x from df)"
    c["cb"] = "select feature, role, b, count(*) k from cl group by all"
    for src, out in (("nb", "pn"), ("cb", "pc")):
        c[f"{out}w"] = (f"select feature, b, " + ", ".join(
            f"coalesce(sum(case when role = '{r}' then k end), 0) / (select sum(k) from {src} z where z.feature = q.feature and z.role = '{r}') {r}" for r in ("train", "valid", "oos"))
            + f" from {src} q group by feature, b")
        c[out] = "select feature, " + ", ".join(
            f"round(sum((greatest({r}, 1e-6) - greatest(train, 1e-6)) * ln(greatest({r}, 1e-6) / greatest(train, 1e-6))), 6) psi_{r}" for r in ("valid", "oos")) + f" from {out}w group by 1"
    allf = [*NUM, *CAT]
    c["miss"] = " union all ".join(
        f"select '{x}' feature, " + ", ".join(f"round(count(*) filter (role = '{r}' and {x} is null) / count(*) filter (role = '{r}'), 6) missing_{r}" for r in ("train", "valid", "oos"))
        + f", count(distinct case when role = 'train' then {x} end) reference_values from df" for x in allf)
    from .sqlkit import blank as bl
    cs = {"AUTO_ON": truth("model_ver_montrg_auto_flag"), "NO_REPORT": bl("model_ver_dev_report_sid"),
          "PREVALIDATED_EMPTY": f"{truth('model_ver_prevalid_flag')} and {bl('model_ver_prevalid_rslt_name')}"}

    def pick(cond, salt, part, n, reason):
        return (f"(select model_ver_sid, {reason} reason from (select *, row_number() over ({part} order by md5('diag:{salt}|' || model_ver_sid), model_ver_sid) r from mv where {cond}) where r <= {n})")

    c["reasons"] = " union ".join(
        [pick(x, n, "", 5, f"'{n}'") for n, x in cs.items()]
        + [pick("model_ver_signfcnt_ctgry_code is not null", "category", "partition by model_ver_signfcnt_ctgry_code", 3, "'SIGNIFICANCE=' || model_ver_signfcnt_ctgry_code"),
           pick("true", "random", "", 10, "'RANDOM'")])
    c["diag"] = "select model_ver_sid, array_to_string(list_sort(list(distinct reason)), ' | ') sample_reason from reasons group by 1"
    return c


def w(body):
    return ctes(**only(base_ctes(), body)) + body


def ORACLE():
    from modelwarden.demo import duck_sql

    r5 = ["train", "valid", "oos", "oot", "test"]
    pairs = " union all ".join(
        f"(select '{a}' left_role, '{b}' right_role, count(*) shared_groups from (select o_custkey from role_gt where role = '{a}' intersect select o_custkey from role_gt where role = '{b}'))"
        for i, a in enumerate(r5) for b in r5[i + 1:])
    staged = " union all ".join(
        f"(select o_orderkey, '{n}' stage, round(1.0 / case when y = 1 then {p} else {q} end, 6) selection_weight from role_random where role = '{src}' and {u(KEY, 'stage')} < case when y = 1 then {p} else {q} end)"
        for n, (src, p, q) in STAGES.items())
    half = "case when category in ('A','B') then n when category in ('C','D') then {f}(n / 2.0) else 0 end"
    known = "case when category in ('A','B','C','D','E') then category else 'EMPTY_OR_OTHER' end"
    seen = "date_part('{0}', t)::double"
    return {
        "split_random": w("select o_orderkey, role from role_random"), "split_group": w("select o_orderkey, role from role_group"),
        "split_stratified": w("select o_orderkey, role from role_strat"), "split_temporal": w("select o_orderkey, role from role_temporal"),
        "split_group_temporal": w("select o_orderkey, role from role_gt"),
        "split_time_cutoffs": w(f"select {ts('half')} half, {ts('late')} late, {ts(chr(34) + 'last' + chr(34))} \"last\" from cuts"),
        "split_statistics": w(f"select role, count(*) \"rows\", count(*) filter (y = 1) positives, count(*) filter (y = 0) negatives, {ts('min(t)')} time_min, {ts('max(t)')} time_max, "
                              "count(distinct o_custkey) \"groups\" from role_gt group by 1"),
        "split_group_overlap": w(pairs),
        "split_row_accounting": w("select count(*) input_rows, count(*) filter (role <> 'purged') assigned_rows, count(*) filter (role = 'purged') purged_rows, cast(0 as bigint) unaccounted_rows from role_gt"),
        "split_auto": w(" union all ".join(f"(select '{m}' as mode, role, count(*) \"rows\" from {t} group by 2)" for m, t in (("stratified", "role_strat"), ("group", "role_group"), ("temporal", "role_temporal"), ("group_temporal", "role_gt")))),
        "split_config_rules": w("select 'sound' as configuration, '' problems, role, count(*) \"rows\" from role_random group by 3 union all select c, p, null, (select count(*) from role_random) from (values "
                                "('no_train', 'train and valid need a positive fraction'), ('sum', 'fractions sum to 1'), ('oot_without_time', 'an out-of-time part needs a temporal mode'), ('group_without_columns', 'group needs group columns')) v(c, p)"),
        "split_manifest": w("select 'group_temporal' as mode, 'o_custkey' group_columns, 't' time_column, input_rows, assigned_rows, input_rows - assigned_rows purged_rows, cast(0 as bigint) unaccounted_rows, role, \"rows\", positives, negatives, \"groups\" from "
                            "(select role, count(*) \"rows\", count(*) filter (y = 1) positives, count(*) filter (y = 0) negatives, count(distinct o_custkey) \"groups\" from role_gt group by 1), "
                            "(select count(*) input_rows, count(*) filter (role <> 'purged') assigned_rows from role_gt)"),
        "split_class_problems": w("select role, \"rows\", positives, case when positives = 0 or positives = \"rows\" then 'ONE_CLASS' else 'FEW_POSITIVES' end problem from "
                                  "(select role, count(*) \"rows\", count(*) filter (y = 1) positives from role_gt group by 1) where positives < 600 or positives = \"rows\""),
        "split_input_checks": w("select count(*) \"rows\", count(*) filter (y is null) target_nulls, count(*) filter (t is null) time_nulls, count(*) filter (o_custkey is null) group_nulls, "
                                "count(distinct y) classes, count(*) filter (y = 1) positive_rows from m"),
        "split_leakage": w("select role, count(distinct o_custkey) shared_keys from role_random where role <> 'train' and o_custkey in (select o_custkey from role_random where role = 'train') group by 1"),
        "fold_hash": w(" union all ".join(
            f"(select o_orderkey, {r} repeat, cast(floor({u(KEY + ' || ' + chr(39) + '|' + chr(39) + ' || cast(y as varchar)', SEED + r * 1009)} * 4) as integer) fold from m)" for r in range(2))),
        "fold_temporal": w("select o_orderkey, fold, part from tf"),
        "fold_temporal_purged": w("select fold, p2 part, count(*) \"rows\", count(distinct o_custkey) \"groups\" from tfp group by 1, 2"),
        "sample_bernoulli": "select l_orderkey, l_linenumber from lineitem where " + bucket("'17|' || l_orderkey || '|' || l_linenumber") + " / 4294967296.0 < 1000.0 / (select count(*) from lineitem)",
        "sample_class_hash": w(f"select o_orderkey, y, round(1.0 / case when y = 1 then 0.7 else 0.2 end, 6) selection_weight from m where {u(KEY)} < case when y = 1 then 0.7 else 0.2 end"),
        "sample_staged": w(staged),
        "sample_fixed_size": w("select o_orderkey, y from (select o_orderkey, y, row_number() over (partition by y order by md5('42|' || cast(o_orderkey as varchar)), o_orderkey) r, "
                               "count(*) over (partition by y) n, count(*) over () t from m) where r <= least(round(1000.0 * n / t), n)"),
        "sample_category_quota": w(f"select model_ver_sid, category from cat where r <= {half.format(f='ceil')}"),
        "sample_quota_control": w(
            f"select k.category, coalesce(operational_count, 0) operational_count, coalesce(expected_selected, 0) expected_selected, coalesce(expected_selected, 0) selected_count from "
            f"(select unnest(['A','B','C','D','E','EMPTY_OR_OTHER']) category) k left join (select {known} category, count(*) operational_count, "
            f"cast(count(*) filter (r <= {half.format(f='floor')}) as bigint) expected_selected from cat group by 1) q using (category)"),
        "sample_cases": w("select * from diag"),
        "sample_related_rows": w(" union all ".join(
            f"(select 't_{t}' table_name, count(*) \"rows\" from ({duck_sql(t)}) where {k} in (select model_ver_sid from diag))"
            for t, k in (("valid", "model_ver_sid"), ("sample_data", "model_ver_sid"), ("model_ver", "model_ver_sid"), ("ent_param_chg", "ent_sid")))),
        "feature_datetime": w("select o_orderkey, epoch(t)::double t__timestamp, " + ", ".join(f"{seen.format(p)} t__{n}" for p, n in (
            ("year", "year"), ("month", "month"), ("day", "day"), ("quarter", "quarter"))) + ", (date_part('isodow', t) - 1)::double t__dayofweek from m"),
        "feature_clean_infinite": w("select o_orderkey, o_totalprice a, case when o_orderkey % 9 not in (0, 1) then c_acctbal end b from m"),
        "feature_constant": "select unnest(['one','half','none','c_mktsegment','o_totalprice']) feature, unnest(['DROP_CONSTANT_TRAIN','KEEP','DROP_CONSTANT_TRAIN','KEEP','KEEP']) status",
        "feature_date_text": w(" union all ".join(
            f"(select '{n}' column_name, count(v) \"values\", round(count(*) filter (regexp_matches(v, '^(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}|\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}})$')) / count(v), 6) pattern_rate, "
            f"round(count(coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%d.%m.%Y'))) / count(v), 6) parse_rate, count(coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%d.%m.%Y'))) / count(v) >= 0.9 is_date "
            f"from (select {e} v from m))" for n, e in (("iso", "strftime(t, '%Y-%m-%d')"), ("local", "strftime(t, '%d.%m.%Y')"),
                                                        ("mixed", "case when o_orderkey % 3 = 0 then 'n/a' else strftime(t, '%Y-%m-%d') end"), ("c_mktsegment", "c_mktsegment")))),
        "feature_universe": w(" union all ".join(f"(select '{c}' feature, {str(c in CAT).lower()} categorical, count({c}) filled from m)" for c in (*NUM, *CAT))),
        "feature_fill_categorical": w("select o_orderkey, coalesce(grade, '__MISSING__') grade, c_mktsegment from m"),
        "feature_categorical_nulls": w(" union all ".join(f"(select '{c}' column_name, count(*) filter ({c} is null) null_count from m)" for c in CAT)),
        "feature_binary_target": w("select case when o_orderstatus = 'F' then 'F' else 'open' end o_orderstatus, cast(o_orderstatus = 'F' as integer) y, count(*) \"rows\" from m group by 1, 2"),
        "feature_entity_aggregates": w(
            "select o_orderkey, o_custkey, o_totalprice, o_orderstatus, round(s, 6) amount_sum, round(a, 6) amount_mean, n row_count, d category_count, x amount_max from m join "
            "(select o_custkey, sum(o_totalprice) s, avg(o_totalprice) a, count(*) n, count(distinct o_orderstatus) d, max(o_totalprice) x from m group by 1) using (o_custkey)"),
        "drift_psi_numeric": w("select * from pn"), "drift_psi_categorical": w("select * from pc"),
        "drift_report": w("select p.*, q.* exclude (feature) from (select * from pn union all select * from pc) p join miss q using (feature)"),
    }
