"""Change log and lifecycle queries with their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import AS_OF, Registry, duck_sql
from modelwarden.operators import changelog as cl
from modelwarden.operators import lifecycle as lc
from pyspark.sql import functions as F

from .development import only
from .sqlkit import END, ctes, current, like, live, plain, ts

LABELS = {"V0": "Planned", "V1": "Running"}
CUTOFF = "2007-12-20 00:00:00"
ACTIVE = ("IMPLEMENTATION_EXPLOIT", "IMPLEMENTATION_DONE")


def reg(spark, sf):
    return Registry.of(spark, sf)


def log(spark, sf):
    return cl.normalise_log(reg(spark, sf).raw("ent_param_chg"), portable=True)


def linked(spark, sf):
    return cl.link_versions(cl.quality_flags(log(spark, sf)), reg(spark, sf).raw("model_ver"))


def changes(spark, sf):
    return linked(spark, sf).filter("linked")


def history(spark, sf):
    r = reg(spark, sf)
    return cl.version_history(r.raw("ent_param_chg"), r.current("model_ver"), AS_OF)


def ids(spark, sf):
    return reg(spark, sf).current("model_ver").select("model_ver_sid", "model_sid")


def q_status_history(spark, sf):
    r = reg(spark, sf)
    tasks = r.raw("model_ver_x_busn_task").select("busn_task_sid")
    return lc.status_history(tasks, "busn_task_sid", r.raw("ent_param_chg"), "BUSINESS_TASK_STATUS", CUTOFF, AS_OF, LABELS)


def q_pair(spark, sf):
    return lc.parameter_pair(ids(spark, sf), reg(spark, sf).raw("ent_param_chg"), "MODEL_VERSION_IMPORTANCE_UMR", "MODEL_VERSION_MODEL_EFFECT")


def q_events(spark, sf):
    r = reg(spark, sf)
    return lc.event_log(ids(spark, sf), r.raw, r.raw("ent_param_chg"))


def q_stage(spark, sf):
    links = ids(spark, sf).withColumn("entity_sid", F.col("model_ver_sid"))
    return lc.change_stage(links, "entity_sid", reg(spark, sf).raw("ent_param_chg"), ["MODEL_VERSION_STATUS"], "Model development")


def q_facts(spark, sf):
    r = reg(spark, sf)
    return lc.fact_stages(ids(spark, sf), r.current, AS_OF)


QUERIES = {
    "log_normalised": lambda s, f: plain(log(s, f)),
    "log_entity_type_stats": lambda s, f: plain(cl.entity_type_stats(log(s, f))),
    "log_parameter_stats": lambda s, f: cl.parameter_stats(log(s, f)),
    "log_quality_flags": lambda s, f: cl.quality_flags(log(s, f)).select("change_sid", "duplicate_event", "same_value", "invalid_interval"),
    "log_quality_summary": lambda s, f: cl.quality_summary(cl.quality_flags(log(s, f))),
    "log_anomalies": lambda s, f: cl.anomalies(cl.quality_flags(log(s, f))),
    "log_link_stats": lambda s, f: cl.link_stats(linked(s, f)),
    "log_version_activity": lambda s, f: plain(cl.version_activity(changes(s, f), "2007-12-25", 14)),
    "log_bursts": lambda s, f: plain(cl.bursts(changes(s, f), 2)),
    "log_reversals": lambda s, f: plain(cl.reversals(changes(s, f))),
    "log_after_validation": lambda s, f: cl.after_validation(changes(s, f), reg(s, f).raw("valid"), 480).withColumn(
        "hours_after_validation", F.round("hours_after_validation", 6)),
    "log_control_readiness": lambda s, f: cl.control_readiness(linked(s, f)),
    "log_readiness_overall": lambda s, f: cl.readiness_overall(cl.control_readiness(linked(s, f))),
    "log_change_sequence": lambda s, f: plain(cl.change_sequence(history(s, f)).drop("source_dttm", "previous_value")),
    "log_change_sequence_certain": lambda s, f: plain(cl.change_sequence_certain(history(s, f)).drop("source_dttm", "previous_value")),
    "log_changes_by_version": lambda s, f: plain(cl.changes_by_version(history(s, f))),
    "log_changes_by_parameter": lambda s, f: cl.changes_by_parameter(history(s, f)),
    "life_card": lambda s, f: plain(lc.assemble_card(reg(s, f).raw)),
    "life_card_business_names": lambda s, f: plain(lc.business_names(lc.assemble_card(reg(s, f).raw))),
    "life_status_history": lambda s, f: plain(q_status_history(s, f)),
    "life_parameter_pair": lambda s, f: plain(q_pair(s, f)),
    "life_change_stage": lambda s, f: plain(q_stage(s, f)),
    "life_event_log": lambda s, f: plain(q_events(s, f)),
    "life_bounds": lambda s, f: plain(lc.bounds(q_facts(s, f))),
    "life_fact_stages": lambda s, f: plain(q_facts(s, f)),
    "life_operational_perimeter": lambda s, f: lc.operational_perimeter(reg(s, f).current, ACTIVE),
}


def clean(x):
    return f"case when lower(trim({x})) not in ('','null','none') then trim({x}) end"


def newest(name, key, cols, where="true"):
    rest = ", ".join(f"{c} desc nulls last" for c in sorted(cols))
    return (f"select {key}, {', '.join(cols)} from (select *, row_number() over (partition by {key} order by start_dt desc nulls last, {rest}) rn_ "
            f"from ({duck_sql(name)}) where {key} is not null and {where}) where rn_ = 1")


@lru_cache(None)
def base_ctes():
    usr = "coalesce({0}, '$NULL$')"
    u1, u2 = clean("ent_param_chg_usr_sid"), clean("ent_param_chg_usr_name")
    key = "entity_sid, entity_type, parameter_name, previous_value, new_value, change_dttm, user_key"
    c = dict(
        raw_log=duck_sql("ent_param_chg"), mv_raw=duck_sql('model_ver'), mv_live=f"select * from mv_raw where {live()}", mv=current("model_ver"), valid=duck_sql("valid"),
        lg=f"select event_sid change_sid, ent_sid entity_sid, upper({clean('ent_type_name')}) entity_type, ent_param_chg_sid parameter_sid, {clean('ent_param_chg_name')} parameter_name, "
           f"{clean('ent_param_chg_prev_val')} previous_value, {clean('ent_param_chg_val')} new_value, upper({clean('ent_param_chg_type_code')}) change_type, "
           f"start_dttm change_dttm, end_dttm change_end_dttm, substr(sha256('|' || {usr.format(u1)} || '|' || {usr.format(u2)}), 1, 16) user_key, "
           f"({u1} is null and {u2} is null) missing_user, coalesce(regexp_matches({clean('ent_param_chg_name')}, '(?i)(purchase|error|status|effect|importance)'), false) critical "
           f"from raw_log where {live()}",
        ql=f"select *, count(*) over (partition by {key}) > 1 duplicate_event, coalesce(previous_value = new_value, false) same_value, "
           "coalesce(change_end_dttm < change_dttm, false) invalid_interval from lg",
        lk="select *, entity_sid is not null and entity_sid in (select model_ver_sid from mv_live) linked from ql",
        ch="select * from lk where linked",
        rd="select count(*) n, count(*) filter (linked) a, count(change_dttm) b, count(*) filter (not missing_user) c, "
           "count(*) filter (previous_value is not null or new_value is not null) d, count(*) filter (critical) e from lk",
        ready="select k check_name, num numerator, n denominator, round(100.0 * num / n, 2) metric_pct, case when k = 'SOURCE_NOT_EMPTY' then "
              "case when num > 0 then 'REALIZABLE' else 'NOT_REALIZABLE' end when k = 'CRITICAL_PARAMETER_EVENTS' then case when num > 0 then 'REALIZABLE' else 'NOT_CONFIRMED' end "
              "when round(100.0 * num / n, 2) >= 80 then 'REALIZABLE' when round(100.0 * num / n, 2) >= 20 then 'PARTIAL' else 'NOT_REALIZABLE' end readiness_status from "
              "(select n, unnest(['DIRECT_MODEL_VERSION_LINK','CHANGE_TIMESTAMP_PRESENT','AUTHOR_PRESENT_HASHED','OLD_OR_NEW_VALUE_PRESENT','CRITICAL_PARAMETER_EVENTS','SOURCE_NOT_EMPTY']) k, "
              "unnest([a, b, c, d, e, n]) num from rd)",
        hist=f"select distinct ent_sid model_ver_sid, ent_param_chg_sid parameter_sid, event_sid, start_dttm change_dttm, ctl_datechange source_dttm, ent_param_chg_prev_val previous_value, "
             f"ent_param_chg_val new_value from raw_log where {live()} and (start_dttm is null or start_dttm <= {END}) and (starts_with(upper(ent_param_chg_sid), 'MODEL_VERSION_') or "
             "upper(trim(ent_type_name)) in ('MODEL_VERSION','MODEL_VER')) and ent_sid in (select model_ver_sid from mv)",
        seq="select model_ver_sid, parameter_sid, event_sid, change_dttm, new_value, row_number() over (partition by model_ver_sid, parameter_sid order by change_dttm nulls last, source_dttm nulls last, event_sid) change_number, "
            "first_value(new_value) over w current_value, event_sid = first_value(event_sid) over w is_latest from hist window w as (partition by model_ver_sid, parameter_sid "
            "order by change_dttm desc nulls last, source_dttm desc nulls last, event_sid desc rows between unbounded preceding and unbounded following)",
        s1="select *, dense_rank() over (partition by model_ver_sid, parameter_sid order by change_dttm nulls last, source_dttm nulls last) change_number, "
           "dense_rank() over (partition by model_ver_sid, parameter_sid order by change_dttm desc nulls last, source_dttm desc nulls last) = 1 top, "
           "count(*) filter (change_dttm is null) over (partition by model_ver_sid, parameter_sid) undated_changes from hist",
        s2="select *, count(*) filter (top) over (partition by model_ver_sid, parameter_sid) latest_candidates, max(case when top then new_value end) over (partition by model_ver_sid, parameter_sid) tv from s1",
        last_valid=f"select model_ver_sid, max(valid_end_fact_dttm) e from valid where {live()} and model_ver_sid is not null and valid_end_fact_dttm is not null and "
                   + like("trim(valid_stts_name)", "DONE|NEGATIVE|COMPLET|FINISH|ЗАВЕРШ") + " group by 1",
        tasks=f"select distinct busn_task_sid from ({duck_sql('model_ver_x_busn_task')})",
        cap=f"select *, case when end_dttm is null or end_dttm > {END} or year(end_dttm) >= 9999 then {END} else end_dttm end capped from raw_log",
        spans="select ent_sid, ent_param_chg_sid p, min(start_dttm) s, max(start_dttm) e from raw_log group by 1, 2 having min(start_dttm) is not null",
    )
    names = list(lc.MODEL_COLUMNS)
    mcols = ", ".join(names)
    c["card_m"] = (f"select model_sid, {mcols} from (select *, row_number() over (partition by model_sid order by start_dt desc) r from ({duck_sql('model')})) where r = 1")
    c["card_v"] = (f"select {', '.join(lc.VERSION_COLUMNS)} from (select *, row_number() over (partition by model_sid order by start_dt desc, model_ver_sid desc) r from mv_raw where model_sid is not null) where r = 1")
    joins, sel = "", []
    for i, (t, key, cols) in enumerate(lc.CARD_STEPS):
        src = {"model_ver_sid": "card_v", "busn_task_sid": "s1_", "montrg_manual_sid": "s3_", "montrg_auto_sid": "s4_", "model_ver_prom_sid": "s2_"}[key]
        joins += f" left join ({newest(t, key, cols)}) s{i}_ on s{i}_.{key} = {src}.{key}"
        sel += [f"s{i}_.{x}" for x in cols]
    stamp = lambda x: f"{ts(x)} {x.split('.')[-1]}" if x.endswith("_dttm") else x
    c["card_l"] = ("select " + ", ".join([stamp(f"card_v.{x}") for x in lc.VERSION_COLUMNS] + [f"card_m.{x}" for x in names] + [stamp(x) for x in sel])
                   + " from card_v join card_m using (model_sid)" + joins)
    v = "model_ver_sid"
    c["l_busn"] = newest("model_ver_x_busn_task", v, ["busn_task_sid"])
    c["l_valid"] = newest("valid", v, ["valid_sid"])
    c["l_auto"] = newest("model_ver_x_montrg_auto", v, ["montrg_auto_sid"])
    c["l_prom"] = newest("model_ver_prom", v, ["model_ver_prom_sid"], "model_ver_prom_stts_name = 'MODEL_PROM_VERSION_EXPLOIT_PERMITTED'")
    c["l_it"] = newest("valid_it", "model_ver_prom_sid", ["valid_it_sid"])
    c["l_impl"] = newest("model_ver_prom_x_prom_implm", "model_ver_prom_sid", ["prom_implm_sid"])

    def stage(links, entity, params, name):
        return (f"select l.model_ver_sid, '{name}' stage, min(s) start_dt, max(e) end_dt from {links} l join spans on spans.ent_sid = l.{entity} "
                f"where p in ({', '.join(repr(p) for p in params)}) and l.model_ver_sid in (select model_ver_sid from mv) group by 1")

    c["ev"] = " union all ".join(f"({x})" for x in (
        stage("l_busn", "busn_task_sid", ["BUSINESS_TASK_STATUS"], "Business task set"),
        stage("mv", "model_ver_sid", ["MODEL_VERSION_STATUS"], "Model development"),
        "select model_ver_sid, 'Prevalidation' stage, min(model_ver_prevalid_dttm) start_dt, max(model_ver_prevalid_dttm) end_dt from mv_raw where model_ver_sid in "
        "(select model_ver_sid from mv) group by 1 having min(model_ver_prevalid_dttm) is not null",
        stage("l_valid", "valid_sid", ["VALIDATION_STATUS"], "Validation"), stage("l_auto", "montrg_auto_sid", ["MONITORING_STATUS"], "Automatic monitoring"),
        stage("l_prom", "model_ver_prom_sid", ["MODEL_PROM_VERSION_STATUS"], "Production version development"),
        stage("(select * from l_prom join l_it using (model_ver_prom_sid))", "valid_it_sid", ["IT_VALIDATION_STATUS"], "IT validation"),
        stage("(select * from l_prom join l_impl using (model_ver_prom_sid))", "prom_implm_sid", ["IMPLEMENTATION_STATUS", "IMPLEMENTATION_PILOT_CRITERIA"], "Implementation")))

    def span(src, name, s, e):
        fin = s if e is None else f"greatest(case when {e} is null or {e} > {END} or year({e}) >= 9999 then {END} else {e} end, {s})"
        return (f"select model_ver_sid, '{name}' stage, min({s}) start_dt, max({fin}) end_dt from {src} where {s} is not null and model_ver_sid in (select model_ver_sid from mv) group by 1")

    for t in ("model_ver_prom", "model_ver_x_busn_task", "busn_task", "valid", "model_ver_x_montrg_auto", "montrg_auto", "valid_it", "prom_implm", "pilot_implm",
              "model_ver_prom_x_prom_implm", "model_ver_prom_x_pilot_implm"):
        c[f"k_{t}"] = current(t)
    impl = " union all ".join(
        f"select p.model_ver_sid, i.{k}_implm_start_fact_dttm s, i.{k}_implm_end_fact_dttm f from k_model_ver_prom p join k_model_ver_prom_x_{k}_implm x using (model_ver_prom_sid) "
        f"join k_{k}_implm i using ({k}_implm_sid)" for k in ("prom", "pilot"))
    c["facts"] = " union all ".join(f"({x})" for x in (
        span("(select x.model_ver_sid, b.* from k_model_ver_x_busn_task x join k_busn_task b using (busn_task_sid))", "Business task set", "coalesce(busn_task_start_dttm, busn_task_crtn_dttm)", "busn_task_end_dttm"),
        span("mv", "Model development", "model_ver_dev_start_fact_dttm", "model_ver_dev_end_fact_dttm"), span("mv", "Prevalidation", "model_ver_prevalid_dttm", None),
        span("k_valid", "Validation", "valid_start_fact_dttm", "valid_end_fact_dttm"),
        span("(select x.model_ver_sid, b.* from k_model_ver_x_montrg_auto x join k_montrg_auto b using (montrg_auto_sid))", "Automatic monitoring", "montrg_auto_start_dttm", "montrg_auto_end_dttm"),
        span("k_model_ver_prom", "Production version development", "model_ver_prom_crtn_dttm", "model_ver_prom_distr_end_dttm"),
        span("(select p.model_ver_sid, b.* from k_model_ver_prom p join k_valid_it b using (model_ver_prom_sid))", "IT validation", "valid_it_start_dttm", "valid_it_end_dttm"),
        span(f"({impl})", "Implementation", "s", "f")))
    live_impl = " union ".join(
        f"select x.model_ver_prom_sid from k_model_ver_prom_x_{k}_implm x join k_{k}_implm i using ({k}_implm_sid) where upper(trim(i.{k}_implm_stts_name)) in {ACTIVE}" for k in ("prom", "pilot"))
    c["oper"] = (f"select model_sid, model_ver_sid, significance from (select *, upper(trim(model_ver_signfcnt_ctgry_code)) significance, row_number() over (partition by model_sid order by "
                 "model_ver_signfcnt_ctgry_dttm desc nulls last, model_ver_crtn_dttm desc nulls last, model_ver_sid desc) r from mv where model_sid is not null and "
                 "upper(trim(model_ver_signfcnt_ctgry_code)) in ('A','B','C','D') and model_ver_sid in (select model_ver_sid from k_model_ver_prom where model_ver_prom_sid in "
                 f"({live_impl}))) where r = 1")
    return c


def w(body):
    return ctes(**only(base_ctes(), body)) + body


def ORACLE():
    st = f"{ts('start_dt')} start_dt, {ts('end_dt')} end_dt"
    missing = ", ".join(f"count(*) filter ({c} is null) missing_{n}" for n, c in (
        ("entity_sid", "entity_sid"), ("entity_type", "entity_type"), ("parameter", "parameter_name"), ("previous_value", "previous_value"), ("new_value", "new_value"), ("change_dttm", "change_dttm")))
    card_order = [*lc.MODEL_COLUMNS, *lc.VERSION_COLUMNS, *[x for _, _, f in lc.CARD_STEPS for x in f]]
    return {
        "log_normalised": w(f"select * exclude (change_dttm, change_end_dttm), {ts('change_dttm')} change_dttm, {ts('change_end_dttm')} change_end_dttm from lg"),
        "log_entity_type_stats": w(
            f"select coalesce(entity_type, '$NULL$') entity_type, count(*) change_count, count(distinct entity_sid) entity_count, count(distinct parameter_name) parameter_count, "
            f"{ts('min(change_dttm)')} first_change, {ts('max(change_dttm)')} last_change, round(100.0 * count(*) / (select count(*) from lg), 2) share_pct from lg group by 1"),
        "log_parameter_stats": w("select entity_type, parameter_name, count(*) change_count, count(distinct entity_sid) entity_count, count(distinct user_key) user_count from lg group by 1, 2"),
        "log_quality_flags": w("select change_sid, duplicate_event, same_value, invalid_interval from ql"),
        "log_quality_summary": w(f"select count(*) row_count, {missing}, count(*) filter (missing_user) missing_user_rows, count(*) filter (same_value) same_value_events, "
                                 "count(*) filter (invalid_interval) invalid_intervals, count(*) filter (duplicate_event) duplicate_event_rows from ql"),
        "log_anomalies": w("select change_sid, entity_sid, entity_type, parameter_name, previous_value, new_value, change_type, same_value, invalid_interval, duplicate_event from ql "
                           "where same_value or invalid_interval or duplicate_event or entity_sid is null or parameter_name is null or change_dttm is null"),
        "log_link_stats": w("select coalesce(entity_type, '$NULL$') entity_type, count(*) change_count, count(*) filter (linked) matched_changes, count(distinct case when linked then entity_sid end) "
                            "matched_versions, round(100.0 * count(*) filter (linked) / count(*), 2) match_pct from lk group by 1"),
        "log_version_activity": w(
            "select entity_sid model_ver_sid, count(*) change_count, count(distinct parameter_name) parameter_count, count(distinct case when not missing_user then user_key end) user_count, "
            "count(*) filter (critical) critical_changes, count(*) filter (change_dttm >= timestamp '2007-12-11 00:00:00') recent_changes, "
            f"{ts('min(change_dttm)')} first_change, {ts('max(change_dttm)')} last_change from ch group by 1"),
        "log_bursts": w(f"select entity_sid model_ver_sid, {ts('h')} change_hour, count(*) changes, count(distinct parameter_name) parameters, count(distinct user_key) users from "
                        "(select *, date_trunc('hour', change_dttm) h from ch where change_dttm is not null) group by entity_sid, h having count(*) >= 2"),
        "log_reversals": w(
            f"select entity_sid model_ver_sid, parameter_name, change_sid, {ts('change_dttm')} change_dttm, l2 before_value, l1 between_value, new_value, user_key from "
            "(select *, lag(new_value, 1) over w_ l1, lag(new_value, 2) over w_ l2 from ch where change_dttm is not null and parameter_name is not null "
            "window w_ as (partition by entity_sid, parameter_name order by change_dttm, change_sid)) where new_value = l2 and new_value <> l1"),
        "log_after_validation": w(
            "select entity_sid model_ver_sid, change_sid, parameter_name, previous_value, new_value, h hours_after_validation, round(h, 2) <= 480 within_limit, critical, user_key from "
            "(select ch.*, round((floor(epoch(change_dttm)) - floor(epoch(e))) / 3600.0, 6) h from ch join last_valid on model_ver_sid = entity_sid where change_dttm > e)"),
        "log_control_readiness": w("select * from ready"),
        "log_readiness_overall": w("select count(*) filter (readiness_status = 'REALIZABLE') realizable_checks, count(*) filter (readiness_status = 'PARTIAL') partial_checks, "
                                   "count(*) filter (readiness_status in ('NOT_REALIZABLE','NOT_CONFIRMED')) not_realizable_checks from ready"),
        "log_change_sequence": w(f"select * exclude (change_dttm), {ts('change_dttm')} change_dttm from seq"),
        "log_change_sequence_certain": w(
            f"select model_ver_sid, parameter_sid, event_sid, {ts('change_dttm')} change_dttm, new_value, change_number, undated_changes, latest_candidates, "
            "latest_candidates = 1 and undated_changes = 0 order_known, case when latest_candidates = 1 and undated_changes = 0 then top end is_latest, "
            "case when latest_candidates = 1 and undated_changes = 0 then tv end current_value from s2"),
        "log_changes_by_version": w(f"select model_ver_sid, count(*) change_count, count(distinct parameter_sid) changed_parameters, {ts('min(change_dttm)')} first_change, {ts('max(change_dttm)')} last_change from hist group by 1"),
        "log_changes_by_parameter": w("select parameter_sid, count(*) change_count, count(distinct model_ver_sid) version_count from hist group by 1"),
        "life_card": w("select * from card_l"),
        "life_card_business_names": w("select " + ", ".join(f'{x} as "{x.upper()}|{text}"' for x, text in lc.HEADINGS.items()) + " from card_l"),
        "life_status_history": w(
            f"select t.busn_task_sid, case upper(trim(ent_param_chg_val)) when 'V0' then 'Planned' when 'V1' then 'Running' else ent_param_chg_val end life_stage, {ts('start_dttm')} start_dttm, "
            f"{ts('capped')} end_dttm from tasks t left join (select * from cap where ent_param_chg_sid = 'BUSINESS_TASK_STATUS' and start_dttm < timestamp '{CUTOFF}') c on c.ent_sid = t.busn_task_sid"),
        "life_parameter_pair":
            ctes(**only(base_ctes(), "raw_log mv"), pv="select ent_sid model_ver_sid, ent_param_chg_sid p, ent_param_chg_val v, start_dttm from (select *, row_number() over "
                 "(partition by ent_sid, ent_param_chg_sid order by start_dttm desc nulls last, event_sid desc) r from raw_log where ent_sid in (select model_ver_sid from mv)) where r = 1")
            + f"select n.model_ver_sid, n.v new_value, {ts('n.start_dttm')} changed_at, o.v old_value from (select * from pv where p = 'MODEL_VERSION_MODEL_EFFECT') n left join "
              "(select * from pv where p = 'MODEL_VERSION_IMPORTANCE_UMR') o using (model_ver_sid)",
        "life_change_stage": w(f"select model_ver_sid, stage, {st} from ev where stage = 'Model development'"),
        "life_event_log": w(f"select model_ver_sid, stage, {st} from ev"),
        "life_fact_stages": w(f"select model_ver_sid, stage, {st} from facts"),
        "life_bounds": w(f"select model_ver_sid, {ts('min(start_dt)')} start_dt, {ts('max(end_dt)')} end_dt from facts group by 1"),
        "life_operational_perimeter": w("select * from oper"),
    }
