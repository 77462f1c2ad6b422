"""Development controls: registered queries and their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import AS_OF, Registry
from modelwarden.plans import development as dev
from modelwarden.plans import engine
from pyspark.sql import functions as F

from .sqlkit import D, END, art, blank, clean, ctes, current, days, like, plain, real, truth, ts, written

DEV = "BACKLOG|DEVELOPMENT|TRAIN_VALIDATION|VERIFICATION|AWAITING_VALIDATION"
STARTED = "DEVELOPMENT|TRAIN_VALIDATION|VERIFICATION|AWAITING_VALIDATION"
GATE = "TRAIN_VALIDATION|VERIFICATION|AWAITING_VALIDATION|DECISION_MAKING|PILOTING_PERMITTED|EXPLOIT_PERMITTED"
P = "model_ver_"
PS, PE, FS, FE = (f"{P}dev_{x}_dttm" for x in ("start_plan", "end_plan", "start_fact", "end_fact"))
UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


@lru_cache(None)
def base_ctes():
    st = f"{P}stts_name"
    return dict(
        mv=current("model_ver"), valid=current("valid"), sample=current("sample_data"), metric=current("metric"),
        versions=f"select * from mv where not {like(st, 'CANCEL|ARCHIV|REJECT')}",
        dur=f"select *, {clean(P + 'dev_dprtmt_name')} department, {days(FE, FS)} dd from versions "
            f"where {real(FS)} and {real(FE)} and {days(FE, FS)} >= 0",
        p90="select department dep, quantile_disc(dd, 0.9) p from dur group by 1 having count(*) >= 5",
        durations="select * from dur join p90 on department = dep",
        samples="select s.* exclude (model_ver_sid), v.model_ver_sid, v.model_ver_dev_dprtmt_name, v.model_ver_signfcnt_ctgry_code "
                "from sample s left join valid x on s.valid_sid = x.valid_sid join versions v "
                "on coalesce(s.model_ver_sid, x.model_ver_sid) = v.model_ver_sid",
        have=f"select sample_data_sid hs, max(case when not {blank('metric_val')} then 1 else 0 end) has_metric from metric group by 1",
        samples2="select * from samples left join have on hs = sample_data_sid",
        metrics="select m.metric_sid, m.metric_name, m.metric_val, s.* from metric m join samples s using (sample_data_sid)",
        metric_groups=f"select model_ver_sid, sample_data_sid, {clean('sample_data_type_name')} sample_type, "
                      f"upper(trim(metric_name)) metric_key, count(*) repeats from metrics where not {blank('metric_name')} group by all",
        returns="select x.valid_sid, upper(x.valid_dev_return_reason_txt) reason, v.* from valid x join versions v using (model_ver_sid) "
                f"where not {blank('x.valid_dev_return_reason_txt')}",
        completed="select x.valid_sid, x.valid_stts_name, x.valid_rslt_name, x.valid_prblm_name, x.valid_dev_return_reason_txt, v.* "
                  "from valid x join versions v using (model_ver_sid) "
                  f"where not {like('x.valid_stts_name', 'CANCEL|NOT_NEEDED|SUSPENDED|REJECT')} and "
                  f"({like('x.valid_stts_name', 'DONE|COMPLETE|RESULTS_APPROVE')} or {real('x.valid_end_fact_dttm')})",
        version_outcomes="select model_ver_sid, model_ver_dev_dprtmt_name, model_ver_signfcnt_ctgry_code, "
                         f"count(*) filter ({like('valid_stts_name', 'DONE_NEGATIVE')} or {like('valid_rslt_name', 'КРАСН|RED')}) negatives, "
                         f"bool_or(not {blank('valid_dev_return_reason_txt')} or {like('valid_rslt_name', 'КРАСН|Ж[ЕЁ]ЛТ|RED|YELLOW')}) bad "
                         "from completed group by 1, 2, 3",
    )


def rules():
    st = f"{P}stts_name"
    dep, stat, sig = clean(P + "dev_dprtmt_name"), clean(st), clean(P + "signfcnt_ctgry_code")
    d, s, g, i = like(st, DEV), like(st, STARTED), like(st, GATE), like(st, "MODEL_VERSION_DEVELOPMENT$")
    rep, repo, com, fs, fsf = (P + x for x in ("dev_report_sid", "repstry_link_txt", "repstry_commit_sid",
                                               "proj_feature_sid", "proj_feature_flag"))
    sty = clean("sample_data_type_name")
    v = "versions"
    problem = (f"case when {blank('valid_prblm_name')} then 'adverse_validation_without_problem_type' else "
               "'adverse_validation:' || regexp_replace(trim(valid_prblm_name), '\\s+', ' ', 'g') end")
    ry = "КРАСН|Ж[ЕЁ]ЛТ|RED|YELLOW"
    return {
        1: (v, f"{d} and {real(PS)} and {real(PE)}", f"{PS} > {PE}", dep, stat, "planned_start_after_planned_end"),
        2: (v, f"{real(FS)} and {real(FE)}", f"{FE} < {FS}", dep, stat, "actual_end_before_actual_start"),
        3: (v, f"{d} and ({real(FS)} or {real(FE)})", f"({real(FS)} and {FS} > {END}) or ({real(FE)} and {FE} > {END})", dep, stat,
            "future_actual_development_date"),
        4: (v, i, real(FE), dep, stat, "development_status_with_actual_end"),
        5: (v, g, f"not {real(FE)}", dep, stat, "post_development_status_without_actual_end"),
        6: (v, f"{d} and {real(PS)} and {real(FS)}", f"{FS} > {PS}", dep, stat, "actual_start_after_plan"),
        7: (v, i, f"not {real(PE)}", dep, sig, "open_development_without_planned_end"),
        8: (v, f"{real(PE)} and {real(FE)}", f"{FE} > {PE}", dep, sig, "development_completed_late"),
        9: ("durations", "true", "dd > p", "department", stat, "duration_above_department_p90"),
        10: (v, s, blank(P + "data_type_name"), sig, stat, "data_type_missing"),
        11: (v, s, blank(P + "method_name"), sig, stat, "modeling_method_missing"),
        12: (v, g, blank(P + "signfcnt_ctgry_code"), dep, stat, "significance_missing_at_gate"),
        13: (v, d, blank(P + "owner_dprtmt_name"), sig, stat, "owner_department_missing"),
        14: (v, s, blank(P + "dev_dprtmt_name"), sig, stat, "development_department_missing"),
        15: (v, f"{d} and {truth(P + 'llm_flag')}", blank(P + "llm_descr_txt"), dep, stat, "llm_description_missing"),
        16: ("samples2", f"{like('sample_data_type_name', 'ТЕСТ|ВАЛИДАЦ')} and not {truth('sample_data_not_metric_calc_flag')}",
             "coalesce(has_metric, 0) = 0", sty, sig, "applicable_sample_without_metric", "SAMPLE_DATA", "sample_data_sid"),
        17: ("metrics", f"not {blank('metric_val')}", "try_cast(trim(metric_val) as double) is null", clean("metric_name"), sty,
             "metric_value_not_numeric", "METRIC", "metric_sid"),
        18: ("metric_groups", "true", "repeats > 1", "metric_key", "sample_type", "duplicate_metric_for_sample", "SAMPLE_METRIC",
             "sample_data_sid || ':' || metric_key"),
        19: (v, g, art(rep), sig, stat, "development_report_missing_at_gate"),
        20: (v, f"{g} and not {art(rep)}", f"not regexp_full_match(trim({rep}), '{UUID}(\\s*,\\s*{UUID})*')", sig, stat,
             "development_report_id_invalid"),
        21: (v, f"{s} and {truth(P + 'prevalid_flag')}", blank(P + "prevalid_rslt_name"), sig, stat, "prevalidation_result_missing"),
        22: (v, f"{d} and not {art(fs)}", f"not {truth(fsf)}", sig, stat, "feature_store_sid_without_true_flag"),
        23: ("returns", "true", "regexp_matches(reason, 'НЕ ПРЕДОСТАВЛЕНЫ ДАННЫЕ')", dep, sig, "validation_return_missing_data",
             "VALIDATION", "valid_sid"),
        24: ("returns", "true", "regexp_matches(reason, 'НЕ ПРЕДОСТАВЛЕН ДОСТУП')", dep, sig, "validation_return_no_data_access",
             "VALIDATION", "valid_sid"),
        25: ("returns", "true", "regexp_matches(reason, 'НЕ ПРЕДОСТАВЛЕНА ИНФОРМАЦИЯ.*ФОРМИРОВАНИЯ ВАЛИДАЦИОННЫХ ВЫБОРОК')", dep, sig,
             "validation_return_insufficient_sample_information", "VALIDATION", "valid_sid"),
        26: ("version_outcomes", "true", "negatives > 1", dep, sig, "repeated_negative_validation", "MODEL_VER_VALIDATION"),
        27: ("completed", "true", like("valid_rslt_name", ry), dep, clean("valid_rslt_name"), ("expr", problem), "VALIDATION", "valid_sid"),
        28: ("version_outcomes", "true", "bad", dep, sig, "negative_development_outcome", "MODEL_VER_VALIDATION"),
        29: (v, f"{s} and not {art(repo)}", art(com), sig, stat, "repository_without_commit"),
        30: (v, f"{s} and not {art(com)}", art(repo), sig, stat, "commit_without_repository"),
        31: (v, f"{d} and {truth(fsf)}", art(fs), sig, stat, "feature_store_true_without_project_sid"),
    }


SEVERITY = {i: "HIGH" for i in range(1, 32)} | {i: "MEDIUM" for i in (4, 6, 7, 9, 15, 17, 18, 20, 21, 22, 31)}


def counts_sql(i):
    base, applies, issue, d1, d2, *_ = rules()[i]
    return (f"select {i} query_id, {d1} dim_1_value, {d2} dim_2_value, "
            f"cast(count(*) filter ({issue}) as bigint) numerator, count(*) denominator from {base} where {applies} group by 2, 3")


def detail_sql(i):
    base, applies, issue, d1, d2, name, *rest = rules()[i]
    entity, sid = (rest + ["MODEL_VER", "model_ver_sid"][len(rest):])[:2]
    iss = name[1] if isinstance(name, tuple) else f"'{name}'"
    return (f"select {i} query_id, '{SEVERITY[i]}' severity, model_ver_sid, '{entity}' source_entity_type, {sid} source_entity_sid, "
            f"{iss} issue_name, {d1} dim_1_value, {d2} dim_2_value from {base} where ({applies}) and ({issue}) and not {blank('model_ver_sid')}")


def only(names, parts):
    """Keep the CTEs that the text refers to, directly or through another CTE."""
    import re

    keep, todo = set(), [parts]
    while todo:
        text = todo.pop()
        for k in names:
            if k not in keep and re.search(rf"\b{k}\b", text):
                keep.add(k)
                todo.append(names[k])
    return {k: names[k] for k in names if k in keep}


def with_base(body):
    return ctes(**only(base_ctes(), body)) + body


_CONTROLS: dict = {}


def controls(spark):
    """The catalogue, built once per session."""
    key = spark.sparkContext.applicationId
    if key not in _CONTROLS:
        _CONTROLS.clear()
        _CONTROLS[key] = dev.controls(AS_OF)
    return _CONTROLS[key]


def bases(spark, sf, names=None):
    r = Registry.of(spark, sf)
    made = dev.bases(r.current("model_ver"), r.current("valid"), r.current("sample_data"), r.current("metric"))
    return {k: made[k]() for k in made if names is None or k in names}


def slices(spark, sf, shown=()):
    """The slices that controls read by table, derived once and kept; ``shown``: columns that other readers of them ask for."""
    r = Registry.of(spark, sf)
    return {t: r.kept(t, [c for c in cols if c in shown or c not in dev.SHOWN_ONLY], written) for t, cols in dev.COLUMNS.items()}


def all_bases(spark, sf, kept=None):
    """All base frames over slices that are derived once and kept for the several readers."""
    kept = kept or slices(spark, sf)
    return controls(spark), {k: make() for k, make in dev.bases(*[kept[t] for t in dev.COLUMNS], hold=written).items()}


def one(i):
    def run(spark, sf):
        c = [c for c in controls(spark) if c.id == i]
        s = engine.summary(spark, bases(spark, sf, {c[0].base}), c, AS_OF)
        return s.select("query_id", "control_status", "dim_1_value", "dim_2_value",
                        F.round("metric_value", 6).alias("metric_value"), "numerator", "denominator")
    return run


def one_sql(i):
    return with_base(
        f"select query_id, 'ASSESSABLE' control_status, dim_1_value, dim_2_value, round(100.0 * numerator / denominator, 6) metric_value, "
        f"numerator, denominator from ({counts_sql(i)})"
    )


def summary_all(spark, sf):
    rules_, b = all_bases(spark, sf)
    return engine.summary(spark, b, rules_, AS_OF)


def detail_all(spark, sf, dims=False, kept=None):
    rules_, b = all_bases(spark, sf, kept)
    return engine.detail(b, rules_, dims)


def q_rollup(spark, sf):
    return engine.control_rollup(summary_all(spark, sf)).select(
        "query_id", "severity", "control_status", "affected_records", "applicable_records", "risk_rate_pct")


def union(f):
    return " union all ".join(f"({f(i)})" for i in range(1, 32))


def dedup_detail():
    return (f"select query_id, source_entity_type, source_entity_sid, issue_name, b.model_ver_sid, b.severity, b.dim_1_value, b.dim_2_value from "
            f"(select query_id, source_entity_type, source_entity_sid, issue_name, min({{'model_ver_sid': model_ver_sid, 'severity': severity, "
            f"'dim_1_value': dim_1_value, 'dim_2_value': dim_2_value}}) b from ({union(detail_sql)}) u group by 1, 2, 3, 4)")


def q_detail(spark, sf):
    return detail_all(spark, sf, dims=True)


def q_versions(spark, sf):
    return engine.version_rollup(detail_all(spark, sf))


def q_issues(spark, sf):
    return engine.issue_rollup(detail_all(spark, sf))


def q_matrix(spark, sf):
    from modelwarden.operators.measures import violation_matrix

    return violation_matrix(detail_all(spark, sf), "model_ver_sid", "query_id", list(range(1, 32)))


INSIDE = "substr(md5(model_ver_sid), 1, 1) <> '0'"


def q_invariants(spark, sf):
    """Every rule against a summary, a detail, a perimeter and a catalogue that are damaged on purpose."""
    rules_, b = all_bases(spark, sf)
    summary = engine.summary(spark, b, rules_, AS_OF)
    summary = summary.withColumn("numerator", F.when(F.col("query_id") == 3, F.col("denominator") + 1).otherwise(F.col("numerator")))
    detail = engine.detail(b, rules_, dims=False)
    detail = detail.withColumn("source_entity_type", F.when(F.col("query_id") == 5, "ELSE").otherwise(F.col("source_entity_type")))
    return engine.invariant_report(summary, detail, b["versions"].filter(INSIDE), dev.ENTITIES, len(rules_) + 2)


def invariants_sql():
    return with_base(
        f"select 'NUMERATOR_RANGE' invariant, count(*) \"rows\" from ({counts_sql(3)}) union all select 'UNKNOWN_ENTITY_TYPE', count(*) from ({dedup_detail()}) where query_id = 5 "
        f"union all select 'OUTSIDE_PERIMETER', count(*) from ({dedup_detail()}) where model_ver_sid not in (select model_ver_sid from versions where {INSIDE}) union all select 'CONTROL_COUNT', 2")


def q_placeholder(spark, sf):
    """A catalogue over a base where some rules find nothing to assess."""
    chosen = [c for c in controls(spark) if c.base == "versions"]
    b = bases(spark, sf, {"versions"})
    b["versions"] = b["versions"].filter(F.upper("model_ver_stts_name").rlike("DECISION_MAKING"))
    s = engine.summary(spark, b, chosen, AS_OF)
    return s.select("query_id", "control_status", "dim_1_value", "dim_2_value", "numerator", "denominator",
                    F.round("metric_value", 6).alias("metric_value"))


def placeholder_sql():
    ids = [i for i in rules() if rules()[i][0] == "versions"]
    parts = " union all ".join(f"({counts_sql(i).replace('from versions', 'from vdm')})" for i in ids)
    body = (f"select i.id query_id, case when c.denominator is null then 'NOT_ASSESSABLE' else 'ASSESSABLE' end control_status, "
            "coalesce(dim_1_value, '$ALL$') dim_1_value, coalesce(dim_2_value, '$ALL$') dim_2_value, numerator, "
            "coalesce(denominator, 0) denominator, round(100.0 * numerator / denominator, 6) metric_value "
            f"from (select cast(unnest({ids}) as integer) id) i left join ({parts}) c on c.query_id = i.id")
    names = dict(base_ctes())
    names["vdm"] = "select * from versions where regexp_matches(upper(model_ver_stts_name), 'DECISION_MAKING')"
    return ctes(**only(names, body)) + body


def q_enriched(spark, sf):
    kept = slices(spark, sf, ("valid_start_fact_dttm", "valid_crtn_dttm"))
    rules_, b = all_bases(spark, sf, kept)
    found = dev.enriched_detail(engine.detail(b, rules_, dims=False), kept["model_ver"], kept["valid"], kept["metric"], b["durations"], b["metric_groups"], written)
    return plain(found)


def enriched_sql():
    dates = {"planned_start": PS, "actual_start": FS, "planned_end": PE, "actual_end": FE}
    shown = {"planned_start": (1, 6, 7, 9), "actual_start": (2, 3, 4, 5, 6, 9), "planned_end": (1, 7, 8, 9), "actual_end": (2, 3, 4, 5, 8, 9)}
    day = lambda a, b, ids, name: f"case when query_id in ({ids}) then round({days('v.' + a, 'v.' + b)}, 2) end {name}"
    cols = [f"case when query_id in {shown[n]} then {ts('v.' + c)} end {n}" for n, c in dates.items()]
    cols += [day(FS, PS, "6", "start_deviation_days"), day(FE, PE, "8, 9", "end_deviation_days"), day(PE, PS, "9", "planned_duration_days"), day(FE, FS, "9", "actual_duration_days"),
             "round(p, 2) expected_days_p90", "round(u.dd, 2) checked_days", "m.metric_name", "m.metric_val metric_value", "g.repeats"]
    cols += [f"{ts('x.' + c)} {n}" for n, c in (("validation_created", "valid_crtn_dttm"), ("validation_started", "valid_start_fact_dttm"), ("validation_ended", "valid_end_fact_dttm"))]
    cols += ["x.valid_stts_name validation_status", "x.valid_rslt_name validation_result", "x.valid_dev_return_reason_txt return_reason"]
    return with_base(
        f"select d.query_id, d.model_ver_sid, d.source_entity_type, d.source_entity_sid, d.issue_name, {', '.join(cols)} from ({dedup_detail()}) d left join mv v on v.model_ver_sid = d.model_ver_sid "
        "left join durations u on d.query_id = 9 and u.model_ver_sid = d.model_ver_sid left join metric m on d.query_id = 17 and m.metric_sid = d.source_entity_sid "
        "left join metric_groups g on d.query_id = 18 and g.model_ver_sid = d.model_ver_sid and g.sample_data_sid || ':' || g.metric_key = d.source_entity_sid "
        "left join valid x on d.query_id in (23, 24, 25) and x.valid_sid = d.source_entity_sid and x.model_ver_sid = d.model_ver_sid")


def q_schedule(spark, sf):
    return dev.schedule_columns(Registry.of(spark, sf).current("model_ver"))


def schedule_sql():
    def d(a, b):
        return f"round({days(a, b)}, 2)"
    return with_base(
        f"select model_ver_sid, {d(FS, PS)} start_deviation_days, {d(FE, PE)} end_deviation_days, {d(PE, PS)} planned_duration_days, "
        f"{d(FE, FS)} actual_duration_days, cast(date_diff('day', cast({PE} as date), cast({FE} as date)) as integer) end_days_late from mv")


QUERIES = {f"dev_control_{i:02d}": one(i) for i in range(1, 32)} | {
    "dev_control_rollup": q_rollup, "dev_control_detail": q_detail, "dev_version_rollup": q_versions,
    "dev_issue_rollup": q_issues, "dev_violation_matrix": q_matrix, "dev_invariants": q_invariants,
    "dev_not_assessable": q_placeholder, "dev_detail_enriched": q_enriched, "dev_schedule_columns": q_schedule,
}


def ORACLE():
    sev = "case query_id " + " ".join(f"when {i} then '{s}'" for i, s in SEVERITY.items()) + " end"
    return {f"dev_control_{i:02d}": one_sql(i) for i in range(1, 32)} | {
        "dev_control_rollup": with_base(
            f"select query_id, {sev} severity, 'ASSESSABLE' control_status, cast(sum(numerator) as bigint) affected_records, "
            f"cast(sum(denominator) as bigint) applicable_records, round(100.0 * sum(numerator) / sum(denominator), 2) risk_rate_pct "
            f"from ({union(counts_sql)}) group by 1"),
        "dev_control_detail": with_base(dedup_detail()),
        "dev_version_rollup": with_base(
            "select model_ver_sid, count(distinct query_id) failed_controls, count(distinct case when severity = 'HIGH' then query_id end) "
            "failed_high_controls, array_to_string(list_sort(list(distinct query_id)), ',') control_ids "
            f"from ({dedup_detail()}) group by 1"),
        "dev_issue_rollup": with_base(
            "select query_id, issue_name, count(distinct source_entity_type || '/' || source_entity_sid) affected_entities, "
            f"count(distinct model_ver_sid) affected_versions from ({dedup_detail()}) group by 1, 2"),
        "dev_violation_matrix": with_base(
            "select model_ver_sid, " + ", ".join(f"cast(max(case when query_id = {i} then 1 else 0 end) as integer) check_{i:02d}" for i in range(1, 32))
            + f" from ({dedup_detail()}) group by 1"),
        "dev_invariants": invariants_sql(),
        "dev_not_assessable": placeholder_sql(),
        "dev_detail_enriched": enriched_sql(),
        "dev_schedule_columns": schedule_sql(),
    }
