"""Portfolio queries and their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import AS_OF, Registry
from modelwarden.plans import portfolio as pf
from pyspark.sql import functions as F

from .development import only
from .sqlkit import D, art, blank, clean, ctes, current, days, dim, falsehood, like, real, truth, written

CLOSED = "DONE|COMPLETE|CLOSED|CANCEL|REJECT|ARCHIV|ЗАВЕРШ|ЗАКРЫТ|ОТМЕН|ОТКЛОН"
DEPLOY = "DECISION_MAKING|OWNER_APPROVE|PILOTING_PERMITTED|PREPARATION_EXPLOIT|EXPLOIT_PERMITTED"
DUE = "VERIFICATION|AWAITING_VALIDATION|TRAIN_VALIDATION|" + DEPLOY
DONE = "DONE|COMPLETE|ЗАВЕРШ"
STATE_COLUMNS = ("start_dt", "end_dt", "ctl_action", "ctl_datechange", "ctl_loading")
TABLES = ("model", "model_ver", "valid", "sample_data", "metric", "model_ver_x_montrg_auto", "model_ver_x_montrg_manual", "montrg_auto",
          "montrg_auto_rslt", "montrg_manual", "montrg_manual_rslt", "model_ver_prom", "valid_it", "pilot_implm", "prom_implm", "genai",
          "genai_ver", "genai_ver_sample_data", "genai_ver_valid")


def newest(table, key, moments, tie):
    return (f"select * exclude (n_) from (select *, row_number() over (partition by {key} order by coalesce({', '.join(moments)}) desc nulls last, "
            f"{tie} desc) n_ from {table} where {key} is not null) where n_ = 1")


def children(parent, child, key, where="true"):
    return f"select p.*, (p.{key} in (select {key} from {child} where {key} is not null and {where})) has_child from {parent} p"


@lru_cache(None)
def base_ctes():
    meta = "exclude (start_dt, end_dt, ctl_action, ctl_datechange)"
    s = "model_ver_stts_name"
    c = {f"t_{t}": current(t) for t in TABLES}
    c |= dict(
        versions=f"select * from t_model_ver where not {like(s, CLOSED)}",
        evidence=f"select * from versions where {like(s, 'DEVELOPMENT|' + DUE)}",
        deploy=f"select * from versions where {like(s, DEPLOY)}",
        due=f"select * from versions where {like(s, DUE)}",
        completed=f"select * from t_valid where not {blank('valid_rslt_name')} and not {like('valid_stts_name', 'CANCEL|REJECT|NOT_NEEDED')} "
                  f"and ({like('valid_stts_name', 'DONE|COMPLETE|RESULTS_APPROVE|ЗАВЕРШ')} or {real('valid_end_fact_dttm')})",
        latest=newest("completed", "model_ver_sid", ["valid_end_fact_dttm", "valid_start_fact_dttm", "valid_crtn_dttm"], "valid_sid"),
        open_valid=f"select *, case when {like('valid_stts_name', 'BACKLOG')} then valid_crtn_dttm else coalesce(valid_start_fact_dttm, "
                   f"valid_crtn_dttm) end anchor from t_valid where {like('valid_stts_name', 'BACKLOG|DATA_PREPARATION|PROCESS|AWAITING_RESULTS|APPROVAL|RESULTS_APPROVE')} "
                   f"and not {like('valid_stts_name', 'NOT_NEEDED|SUSPENDED|CANCEL|CLOSED|DONE|COMPLETE|REJECT|ARCHIV')}",
        vm=f"select * from versions left join (select * {meta} from t_model) using (model_sid)",
        em=f"select * from evidence left join (select * {meta} from t_model) using (model_sid)",
        vmi=f"select * from versions join (select * {meta} from t_model) using (model_sid)",
        lv="select l.*, v.model_ver_signfcnt_ctgry_code from latest l join versions v using (model_ver_sid)",
        red=f"select l.* from latest l join deploy using (model_ver_sid) where {like('l.valid_rslt_name', 'RED|КРАСН')}",
        e_sample=children("evidence", "t_sample_data", "model_ver_sid"),
        e_oot=children("evidence", "t_sample_data", "model_ver_sid", like("sample_data_prop_array", r"OUT[-_ ]?OF[-_ ]?TIME|\bOOT\b|ВНЕВРЕМ")),
        due_valid=children("due", "completed", "model_ver_sid"),
        e_auto=children("evidence", "t_model_ver_x_montrg_auto", "model_ver_sid"),
        s_metric=f"select s.*, s.sample_data_sid in (select sample_data_sid from t_metric where sample_data_sid is not null and not {blank('metric_val')}) "
                 "has_metric from t_sample_data s",
        auto_res=children("(select * from t_montrg_auto_rslt where " + like("montrg_auto_rslt_stts_name", DONE) + ")", "t_sample_data", "montrg_auto_rslt_sid"),
        manual_res=children("(select * from t_montrg_manual_rslt where " + like("montrg_manual_rslt_stts_name", DONE) + ")", "t_sample_data", "montrg_manual_rslt_sid"),
        it=newest("t_valid_it", "model_ver_prom_sid", ["valid_it_end_dttm", "valid_it_start_dttm", "valid_it_crtn_dttm"], "valid_it_sid"),
        prom_it="select p.*, i.valid_it_sid, i.valid_it_stts_name from t_model_ver_prom p left join it i using (model_ver_prom_sid) where "
                + like("p.model_ver_prom_stts_name", "AWAITING_ARTIFACTS|AWAITING_VALIDATION|DEVELOPMENT|READY_FOR_UAT|PILOTING_PERMITTED|EXPLOIT_PERMITTED"),
        implm="select 'pilot' kind, pilot_implm_stts_name status, pilot_implm_start_plan_dttm plan_dt, pilot_implm_start_fact_dttm fact_dt from t_pilot_implm "
              "union all select 'industrial', prom_implm_stts_name, prom_implm_start_plan_dttm, prom_implm_start_fact_dttm from t_prom_implm",
        problems=" union all ".join(
            f"select '{ch}' channel, montrg_{k}_rslt_prblm_name problem from t_montrg_{k}_rslt where not {blank(f'montrg_{k}_rslt_prblm_name')} "
            f"and {like(f'montrg_{k}_rslt_stts_name', DONE)}" for k, ch in (("auto", "automatic"), ("manual", "manual"))),
        gv=f"select * from t_genai_ver where not {like('genai_ver_stts_name', 'BACKLOG|NEW|DRAFT|CANCEL|ARCHIV|REJECT')}",
        gvo="select v.*, g.genai_owner_dprtmt_name from gv v left join t_genai g using (genai_sid)",
        gattr="select a attribute, v as value from (select unnest(['version_status','significance','agent_flag','priority','maturity']) a, unnest(["
              + ",".join([dim("v.genai_ver_stts_name"), dim("v.genai_ver_signfcnt_ctgry_code"), dim("g.genai_agent_flag"),
                          dim("upper(trim(g.genai_priority_lvl_code))"), dim("g.genai_maturity_lvl_ord")])
              + "]) v from t_genai_ver v left join t_genai g using (genai_sid))",
        gv_sample=children("gv", "t_genai_ver_sample_data", "genai_ver_sid"),
        glatest=newest("t_genai_ver_valid", "genai_ver_sid", [f"genai_ver_valid_{x}_dttm" for x in ("end_fact", "start_fact", "crtn")], "genai_ver_valid_sid"),
        gvl="select v.*, l.genai_ver_valid_rslt_name from gv v left join glatest l using (genai_ver_sid)",
        gw=f"select * from t_genai_ver_valid where not {blank('genai_ver_valid_rslt_name')}",
        grun=f"select * from gv where {like('genai_ver_stts_name', 'PILOT|EXPLOIT|PROD|RELEASE|PERMITTED')}",
    )
    return c


def dist(src, d1, d2):
    return (f"select coalesce({d1}, '$NULL$') dim_1_value, coalesce({d2}, '$ALL$') dim_2_value, count(*)::double metric_value, count(*) numerator, "
            f"null::bigint denominator from {src} group by 1, 2")


class Gaps(str):
    """SQL text that knows its source and its (name, applies, bad) indicators."""

    def of(self, src, inds):
        self.src, self.inds = src, inds
        return self


def gap(src, bad, d1, d2):
    return Gaps(f"select {d1} dim_1_value, {d2} dim_2_value, round(100.0 * count(*) filter ({bad}) / count(*), 6) metric_value, "
            f"count(*) filter ({bad}) numerator, count(*) denominator from {src} group by 1, 2").of(src, [(None, "true", bad)])


def multi(src, d2, inds):
    return Gaps(" union all ".join(
        f"(select '{n}' dim_1_value, {d2} dim_2_value, round(100.0 * count(*) filter ({b}) / count(*), 6) metric_value, "
        f"count(*) filter ({b}) numerator, count(*) denominator from {src} where {a} group by 2)" for n, a, b in inds)).of(src, inds)


def quant(src, d1, expr, qs=(("p50", 0.5), ("p90", 0.9))):
    return " union all ".join(
        f"(select {d1} dim_1_value, '{n}' dim_2_value, round(quantile_disc({expr}, {q})::double, 6) metric_value, null::bigint numerator, count(*) denominator "
        f"from {src} where {expr} >= 0 group by 1)" for n, q in qs)


def overdue(x):
    return f"({real(x)} and cast({x} as date) < {D})"


def stale(x):
    return f"(not {real(x)} or date_diff('day', cast({x} as date), {D}) > 365)"


def sql():
    P, V, G, W = "model_ver_", "valid_", "genai_ver_", "genai_ver_valid_"
    sig, gsig, stat = dim(P + "signfcnt_ctgry_code"), dim(G + "signfcnt_ctgry_code"), dim(P + "stts_name")
    repo, com = P + "repstry_link_txt", P + "repstry_commit_sid"
    tgt = ("target", f"not {truth(P + 'llm_flag')} and not {like('model_type_name', 'CLUSTER|КЛАСТЕР|UNSUPERVISED|БЕЗ УЧИТЕЛЯ|EMBEDDING|ЭМБЕДДИНГ')}",
           blank(P + "tgt_txt"))
    pe, fe, fs = P + "dev_end_plan_dttm", P + "dev_end_fact_dttm", P + "dev_start_fact_dttm"
    ff, fp = truth(P + "proj_feature_flag"), blank(P + "proj_feature_sid")
    vd, vs, vr, vt = (V + x for x in ("dprtmt_name", "stts_name", "rslt_name", "type_name"))
    alt, ag, mon = V + "alt_flag", V + "agent_usg_flag", P + "montrg_auto_flag"
    A, M = "montrg_auto_", "montrg_manual_"
    sched = A + "proj_sched_stts_name"
    on = f"upper({dim(sched)}) = 'ACTIVE'"
    grun = like(G + "stts_name", "PILOT|EXPLOIT|PROD|RELEASE|PERMITTED")
    grepo, mf, df = G + "repstry_link_txt", G + "montrg_auto_model_flag", G + "montrg_auto_data_flag"
    post = like("model_ver_prom_stts_name", "READY_FOR_UAT|PILOTING_PERMITTED|EXPLOIT_PERMITTED")
    plan, fact = (f"try_cast({G}fin_effect_{x}_million_qty as double)" for x in ("plan", "fact"))

    def results(kind):
        R = f"montrg_{kind}_rslt_"
        off, none = truth(R + "not_metric_main_flag"), truth(R + "valid_not_sample_data_flag")
        return multi(f"{kind}_res", dim(R + "name"), [
            ("metric_not_calculated", "true", off), ("metric_missing_unexplained", "true", f"{R}metric_val is null and not {off}"),
            ("sample_explicitly_absent", "true", none), ("sample_link_missing_unexplained", "true", f"not has_child and not {none}"),
            ("report_missing", "true", art(R + "report_sid"))])

    def orphan(rel, child, parent, key, skip=False):
        w = f" where c.{key} is not null" if skip else ""
        return (f"(select '{rel}' dim_1_value, '$ALL$' dim_2_value, round(100.0 * count(*) filter (p.{key} is null) / count(*), 6) metric_value, "
                f"count(*) filter (p.{key} is null) numerator, count(*) denominator from t_{child} c left join (select distinct {key} from t_{parent}) p "
                f"using ({key}){w})")

    gdays = (f"case when {real(W + 'start_fact_dttm')} and {real(W + 'end_fact_dttm')} then date_diff('day', cast({W}start_fact_dttm as date), "
             f"cast({W}end_fact_dttm as date)) end")
    swap = multi("s_metric", dim("sample_data_type_name"), [
        ("metric_calc_disabled", "true", truth("sample_data_not_metric_calc_flag")),
        ("metric_missing_unexplained", "true", f"not {truth('sample_data_not_metric_calc_flag')} and not has_metric")])
    closing = multi("gw", dim(W + "rslt_name"), [("report_missing", "true", art(W + "report_sid")),
                                                 ("alt_metric_missing", "true", f"{truth(W + 'alt_flag')} and ({blank(W + 'alt_metric_name')} or {blank(W + 'alt_metric_val')})")])
    return {
        1: dist("versions", sig, stat), 2: dist("vmi", dim("model_type_name"), dim("model_ml_task_name")),
        3: dist(f"vmi where {truth('model_rsk_flag')}", dim("model_rsk_type_name"), dim("model_rsk_sgmnt_name")),
        4: dist(f"versions where {P}signfcnt_ctgry_code in ('A','B')", dim(P + "owner_dprtmt_name"), sig),
        5: multi("vm", sig, [("owner_department", "true", blank(P + "owner_dprtmt_name")), ("method", "true", blank(P + "method_name")),
                             ("significance", "true", blank(P + "signfcnt_ctgry_code")), tgt]),
        6: gap("evidence", art(repo), sig, dim(P + "dev_src_name")),
        7: gap(f"(select * from evidence where not {art(repo)})", art(com), sig, dim(P + "dev_src_name")),
        8: gap("evidence", art(P + "dev_report_sid"), sig, stat),
        9: multi("em", sig, [("data_type", "true", blank(P + "data_type_name")), tgt]),
        10: gap("e_sample", "not has_child", sig, stat), 11: gap("e_oot", "not has_child", sig, stat),
        12: Gaps(f"select dim_2_value dim_1_value, dim_1_value dim_2_value, metric_value, numerator, denominator from ({swap})").of(swap.src, swap.inds),
        13: multi("evidence", clean(P + "dev_dprtmt_name"), [
            ("open_overdue", "true", f"{overdue(pe)} and not {real(fe)}"), ("completed_late", "true", f"{real(pe)} and {real(fe)} and {fe} > {pe}")]),
        14: quant(f"(select * from t_model_ver where {real(fs)} and {real(fe)})", clean(P + "dev_dprtmt_name"), days(fe, fs)),
        15: multi("versions", sig, [("flag_true_project_missing", "true", f"{ff} and {fp}"), ("project_present_flag_not_true", "true", f"not {fp} and not {ff}")]),
        16: gap("due_valid", "not has_child", sig, stat), 17: dist("lv", dim(vr), sig),
        18: gap("open_valid", f"{real('anchor')} and date_diff('day', cast(anchor as date), {D}) > 90", clean(vd), clean(vs)),
        19: gap("open_valid", overdue(V + "freq_start_plan_dttm"), clean(vd), clean(vs)),
        20: quant(f"(select * from completed where {real(V + 'start_fact_dttm')} and {real(V + 'end_fact_dttm')})", clean(vd), days(V + "end_fact_dttm", V + "start_fact_dttm")),
        21: dist(f"t_valid where trim({V}dev_return_reason_txt) <> ''", V + "dev_return_reason_txt", dim(vd)),
        22: gap("completed", truth(V + "not_sample_data_flag"), dim(vr), dim(vt)), 23: gap("completed", truth(V + "src_not_table_flag"), dim(vr), dim(vt)),
        24: gap("completed", art(V + "report_sid"), clean(vr), clean(vd)),
        25: gap("red", f"not {truth(V + 'red_zone_owner_aprvl_rsk_flag')}", clean(vd), clean(vr)),
        26: gap("red", f"{art(V + 'red_zone_comt_rsk_decsn_sid')} or {art(V + 'red_zone_comt_rsk_decsn_link_txt')}", clean(vd), clean(vr)),
        27: dist(f"completed where {V}prblm_name is not null", V + "prblm_name", dim(vr)),
        28: multi("lv", sig, [("alt_flag_missing", "true", blank(alt)), ("alt_not_run", f"not {blank(alt)}", falsehood(alt)),
                              ("alt_metric_missing", truth(alt), f"{blank(V + 'alt_metric_name')} or {blank(V + 'alt_metric_val')}")]),
        29: gap("completed", blank(ag), dim(vt), dim(vr)),
        30: multi("completed", dim(vt), [(n, truth(ag), f"{V}agent_test_{c}_pct is null") for n, c in (
            ("quality_correct_pct", "quality_corr"), ("quality_reuse_pct", "quality_reuse"), ("quantity_reuse_pct", "quantity_reuse"))]
            + [("non_usage_reason", falsehood(ag), blank(V + "agent_non_usg_reason_name"))]),
        31: dist("completed", dim(vt), dim(vs)),
        32: dist("completed", dim(V + "prevalid_reuse_lvl_name"), dim(V + "prevalid_reuse_lvl_reason_array")),
        33: multi("e_auto", sig, [("monitoring_flag_missing", "true", blank(mon)), ("monitoring_link_missing", truth(mon), "not has_child"),
                                  ("link_present_flag_not_true", f"not {truth(mon)}", "has_child")]),
        34: gap(f"(select * from t_montrg_auto where not {like(A + 'stts_name', CLOSED)})", overdue(A + "next_dttm"), dim(A + "dprtmt_name"), dim(A + "stts_name")),
        35: multi("t_montrg_auto", dim(sched), [("schedule_status_missing", "true", blank(sched)), ("cron_missing", on, blank(A + "proj_sched_cron_txt")),
                                               ("schedule_start_missing", on, f"not {real(A + 'proj_sched_start_dttm')}"),
                                               ("next_run_missing", on, f"not {real(A + 'next_dttm')}")]),
        36: results("auto"), 38: results("manual"),
        37: multi(f"(select * from t_montrg_manual where not {like(M + 'stts_name', CLOSED)})", dim(M + "stts_name"), [
            ("last_result_missing", "true", blank(M + "last_rslt_name")), ("last_result_missing_or_stale", "true", stale(M + "last_rslt_dttm")),
            ("next_run_overdue", "true", overdue(M + "next_dttm"))]),
        39: dist("problems", "channel", "problem"),
        40: multi("prom_it", dim("model_ver_prom_stts_name"), [
            ("it_validation_missing_or_incomplete", post, f"valid_it_sid is null or not {like('valid_it_stts_name', DONE)}"),
            ("qgm_flag_missing", post, blank("model_ver_prom_valid_it_rslt_qgm_flag")), ("implementation_flag_missing", post, blank("model_ver_prom_implm_flag"))]),
        41: gap("implm", f"{real('plan_dt')} and ((not {real('fact_dt')} and cast(plan_dt as date) < {D}) or ({real('fact_dt')} and fact_dt > plan_dt))", "kind", dim("status")),
        42: " union all ".join([
            orphan("MODEL_VER->MODEL", "model_ver", "model", "model_sid"), orphan("VALID->MODEL_VER", "valid", "model_ver", "model_ver_sid"),
            orphan("SAMPLE->MODEL_VER", "sample_data", "model_ver", "model_ver_sid", True), orphan("METRIC->SAMPLE", "metric", "sample_data", "sample_data_sid", True),
            orphan("X_AUTO->AUTO", "model_ver_x_montrg_auto", "montrg_auto", "montrg_auto_sid"),
            orphan("X_MANUAL->MANUAL", "model_ver_x_montrg_manual", "montrg_manual", "montrg_manual_sid"),
            orphan("GENAI_VER->GENAI", "genai_ver", "genai", "genai_sid"), orphan("GENAI_SAMPLE->GENAI_VER", "genai_ver_sample_data", "genai_ver", "genai_ver_sid"),
            orphan("GENAI_VALID->GENAI_VER", "genai_ver_valid", "genai_ver", "genai_ver_sid"),
            orphan("VALID_IT->MODEL_VER_PROM", "valid_it", "model_ver_prom", "model_ver_prom_sid")]),
        43: dist("gattr", "attribute", "value"),
        44: multi("gvo", gsig, [("owner", "true", blank("genai_owner_dprtmt_name")), ("repository", "true", art(grepo)),
                                ("commit", f"not {art(grepo)}", f"{art(G + 'repstry_commit_link_txt')} and {art(G + 'distr_commit_link_txt')}"),
                                ("development_report", "true", art(G + "dev_report_sid")), ("release", grun, art(G + "release_link_txt"))]),
        45: multi("gv_sample", gsig, [("sample_missing", "true", "not has_child"),
                                      ("data_knowledge_level_missing", "true", blank(G + "sample_data_knowledge_lvl_name"))]),
        46: dist("gvl", f"coalesce({W}rslt_name, 'NO_VALIDATION')", gsig),
        47: Gaps(closing + f" union all select 'duration_p90_days', dim_1_value, metric_value, numerator, denominator from ({quant('gw', dim(W + 'rslt_name'), gdays, (('p90', 0.9),))})").of(closing.src, closing.inds),
        48: multi("grun", gsig, [("model_monitoring_flag_missing", "true", blank(mf)), ("data_monitoring_flag_missing", "true", blank(df)),
                                 ("model_exclusion_reason_missing", falsehood(mf), blank(G + "montrg_auto_exclude_reason_model_array")),
                                 ("data_exclusion_reason_missing", falsehood(df), blank(G + "montrg_auto_exclude_reason_data_array")),
                                 ("last_result_missing_or_stale", f"({truth(mf)} or {truth(df)})", stale(G + "montrg_last_rslt_dttm"))]),
        49: multi("gv", gsig, [("metric_code_missing", "true", blank(G + "metric_key_code")), ("metric_value_missing", "true", blank(G + "metric_key_val")),
                               ("auto_assessment_missing", "true", blank(G + "metric_assmnt_auto_cmnt_txt"))]),
        50: multi("gv", gsig, [("financial_plan_missing", "true", f"{plan} is null"),
                               ("financial_fact_missing_or_below_plan", f"{plan} > 0", f"{fact} is null or {fact} < {plan}"),
                               ("usage_days_limit_missing", "true", f"{G}usg_days_qty is null"),
                               ("concurrent_usage_limit_missing", "true", f"{G}usg_same_time_cnt is null")]),
    }


def wrap(body):
    return ctes(**only(base_ctes(), body)) + body


def rounded(df):
    return df.withColumn("metric_value", F.round("metric_value", 6))


_QUERIES: dict = {}


def queries(spark):
    """The catalogue, built once per session."""
    key = spark.sparkContext.applicationId
    if key not in _QUERIES:
        _QUERIES.clear()
        _QUERIES[key] = pf.queries(AS_OF)
    return _QUERIES[key]


def context(spark, sf):
    return pf.Context(Registry.of(spark, sf).current, AS_OF)


def kept_context(spark, sf):
    """For many queries at once: each table is derived once, without the columns that only its state needed."""
    r = Registry.of(spark, sf)

    def slim(t):
        return r.kept(t, pf.VERSION_COLUMNS if t == "model_ver" else [c for c in r.raw(t).columns if c not in STATE_COLUMNS], written)

    return pf.Context(slim, AS_OF, written, kept=True)


def one(i):
    def run(spark, sf):
        return rounded(pf.result(queries(spark)[i], context(spark, sf)))
    return run


def united(frames):
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b), frames)


def q_details(spark, sf):
    """Offending rows of every query that has a numerator."""
    c = kept_context(spark, sf)
    return united([pf.details(q, c) for q in queries(spark).values() if q.kind in ("gap", "multi")])


def q_shape(spark, sf):
    """All queries in the common shape, united."""
    c = kept_context(spark, sf)
    parts = [pf.labelled(q, pf.result(q, c), AS_OF) for q in queries(spark).values()]
    return rounded(united(parts)).drop("query_name").withColumn("as_of_dt", F.col("as_of_dt").cast("string"))


#: What a single rate counts, what the rows of a query are (versions, where not named), and results that name no version.
ISSUES = {
    6: "repository_missing", 7: "commit_missing", 8: "development_report_missing", 10: "sample_missing", 11: "oot_sample_missing", 16: "completed_validation_missing",
    18: "validation_open_too_long", 19: "periodic_validation_overdue", 22: "validation_without_sample", 23: "non_tabular_source", 24: "validation_report_missing",
    25: "owner_acceptance_missing", 26: "committee_decision_missing", 29: "agent_flag_missing"}
SOURCES = dict.fromkeys((18, 19, 22, 23, 24, 25, 26, 28, 29, 30), "VALID") | {12: "SAMPLE_DATA", 40: "MODEL_VER_PROM", 47: "GENAI_VER_VALID"}
NO_VERSION = (34, 35, 36, 37, 38, 41)


def details_sql():
    parts = []
    for i, text in sql().items():
        if not isinstance(text, Gaps) or i in NO_VERSION:
            continue
        entity = "GENAI" if i >= 43 else "MODEL"
        source = SOURCES.get(i, "GENAI_VER" if entity == "GENAI" else "MODEL_VER")
        ver = "genai_ver_sid" if entity == "GENAI" else "model_ver_sid"
        parts += [
            f"(select {i} query_id, '{entity}' entity_type, cast({ver} as varchar) version_sid, '{source}' source_entity_type, cast({source.lower()}_sid as varchar) source_entity_sid, "
            f"'{name or ISSUES[i]}' issue_name from {text.src} where ({applies}) and ({bad}) and not {blank(ver)})" for name, applies, bad in text.inds]
    return wrap(" union ".join(parts))


MEASURES = {14: "duration_days", 17: "validation_count", 20: "duration_days", 21: "return_count", 27: "problem_count", 31: "validation_count", 32: "validation_count",
            36: "result_count_or_gap_pct", 38: "result_count_or_gap_pct", 39: "problem_count", 42: "orphan_rate_pct", 47: "risk_rate_pct_or_days"}
DOMAINS = {
    "portfolio": (1, 2, 3, 4), "documentation": (5, 8), "reproducibility": (6, 7), "data_governance": (9, 10, 11, 12, 15), "development": (13, 14),
    "validation": (16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 32), "agent_validation": (29, 30, 31), "monitoring": (33, 34, 35, 36, 37, 38, 39),
    "implementation": (40, 41), "data_quality": (42,), "genai_portfolio": (43,), "genai_governance": (44,), "genai_data": (45,), "genai_validation": (46, 47),
    "genai_monitoring": (48,), "genai_metrics": (49,), "genai_usage": (50,)}
DIMS = {
    ("significance", "status"): (1, 8, 10, 11, 16), ("model_type", "ml_task"): (2,), ("risk_type", "risk_segment"): (3,), ("owner_department", "significance"): (4,),
    ("missing_field", "significance"): (5, 9, 44), ("significance", "dev_source"): (6, 7), ("sample_type", "gap_type"): (12,), ("overdue_type", "department"): (13,),
    ("department", "statistic"): (14, 20), ("indicator", "significance"): (15, 28, 33, 45, 48, 49, 50), ("result", "significance"): (17,), ("department", "status"): (18, 19, 34),
    ("return_reason", "department"): (21,), ("result", "type"): (22, 23), ("result", "department"): (24,), ("department", "result"): (25, 26), ("problem", "result"): (27,),
    ("type", "result"): (29,), ("missing_field", "validation_type"): (30,), ("validation_type", "status"): (31,), ("reuse_level", "reason"): (32,),
    ("schedule_gap", "schedule_status"): (35,), ("indicator_or_result", "result"): (36,), ("indicator", "status"): (37,), ("indicator", "result"): (38, 47),
    ("channel", "problem"): (39,), ("indicator", "prom_status"): (40,), ("implementation_type", "status"): (41,), ("relation", ""): (42,),
    ("portfolio_attribute", "value"): (43,), ("validation_result", "significance"): (46,)}


def shape_sql():
    domain = {i: d for d, ids in DOMAINS.items() for i in ids}
    dims = {i: d for d, ids in DIMS.items() for i in ids}
    parts = []
    for i, text in sql().items():
        measure = MEASURES.get(i, "risk_rate_pct" if isinstance(text, Gaps) else "version_count")
        entity = "ALL" if i == 42 else "GENAI" if i >= 43 else "MODEL"
        parts.append(
            f"(select {i} query_id, '{domain[i]}' risk_domain, '{entity}' entity_type, '{measure}' metric_name, '{dims[i][0]}' dim_1_name, coalesce(q.dim_1_value, '$NULL$') dim_1_value, "
            f"'{dims[i][1]}' dim_2_name, coalesce(q.dim_2_value, '$ALL$') dim_2_value, round(q.metric_value, 6) metric_value, q.numerator, q.denominator, '{AS_OF}' as_of_dt from ({text}) q)")
    return wrap(" union all ".join(parts))


QUERIES = {f"portfolio_{i:02d}": one(i) for i in range(1, 51)} | {"portfolio_details": q_details, "portfolio_result_shape": q_shape}


def ORACLE():
    return {f"portfolio_{i:02d}": wrap(s) for i, s in sql().items()} | {"portfolio_details": details_sql(), "portfolio_result_shape": shape_sql()}
