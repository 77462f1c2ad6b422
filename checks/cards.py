"""Card flags, field statuses and report reconciliation with their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import AS_OF, Registry, duck_sql
from modelwarden.operators import reconcile as rec
from modelwarden.plans import card, fields
from pyspark.sql import functions as F

from .development import only
from .sqlkit import (
    D, category, ctes, current, filled, has_value, is_na, live, location, low, norm, plain, required, state, truth, ts, written,
)


def reg(spark, sf):
    return Registry.of(spark, sf)


_FULL: dict = {}


def full_card(spark, sf):
    """The report as one written table: several comparisons read it, and none needs it in the executors' memory."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FULL:
        _FULL.clear()
        _FULL[key] = written(card.build_card(reg(spark, sf).raw, AS_OF, written))
    return _FULL[key]


def q_card(spark, sf):
    return plain(card.build_card(reg(spark, sf).raw, AS_OF, written))


def true3(x):
    return f"coalesce({norm(x)} in ('true','1','да'), false)"


@lru_cache(None)
def card_ctes():
    loc = location("sample_data_addtnl_info_txt")
    typ = norm("sample_data_type_name")
    moments = ("model_ver_prom_actual_implm_last_dttm", "model_ver_prom_actual_implm_first_dttm", "model_ver_prom_crtn_dttm")
    c = dict(
        models=state("model"), versions=state("model_ver"), an=state("model_ver_anlt_dtl"), prom=state("model_ver_prom"),
        samples=state("sample_data", False), valids=state("valid", False),
        active="select * from (select *, dense_rank() over (partition by model_ver_sid order by "
               + ", ".join(f"{m} desc nulls last" for m in moments) + f") r from an where {true3('model_ver_prom_expl_flag')}) where r = 1",
        code="select model_ver_sid, model_ver_prom_repstry_commit_link_txt link from active join prom using (model_ver_sid, model_ver_prom_sid) "
             f"where {required('model_ver_prom_repstry_commit_link_txt')}",
        uses=f"select upper(trim(model_code)) ck, count(distinct model_sid) uses from models where {required('model_code')} group by 1",
        s_valid=f"select distinct valid_sid from samples where {required('valid_sid')} and {loc}",
        s_ver=f"select distinct model_ver_sid from samples where {required('model_ver_sid')} and contains({typ}, 'валидац') and {loc}",
        s_mon=f"select distinct model_ver_sid from samples where {required('model_ver_sid')} and regexp_matches({typ}, 'монитор|стабил') and {loc}",
        ve="select model_ver_sid, bool_or(res) vr, bool_or(res and (" + true3("valid_not_sample_data_flag")
           + " or valid_sid in (from s_valid) or model_ver_sid in (from s_ver))) vd from (select *, "
           + required("valid_rslt_name") + f" res from valids) where {required('model_ver_sid')} and {required('valid_end_fact_dttm')} "
           f"and cast(valid_end_fact_dttm as date) <= {D} group by 1",
    )
    for k in ("auto", "manual"):
        m = f"montrg_{k}"
        c[f"{k}_res"] = state(f"{m}_rslt", False)
        c[f"{k}_link"] = state(f"model_ver_x_{m}", False)
        c[f"{k}_s"] = f"select distinct {m}_rslt_sid from samples where {required(m + '_rslt_sid')} and {loc}"
        c[f"{k}_m"] = (f"select {m}_sid, bool_or({required(m + '_rslt_name')}) r, bool_or({required(m + '_rslt_name')} and "
                       f"({true3(m + '_rslt_valid_not_sample_data_flag')} or {m}_rslt_sid in (from {k}_s))) d from {k}_res where {required(m + '_sid')} group by 1")
        c[f"{k}_v"] = f"select l.model_ver_sid, l.{m}_sid msid, coalesce(r, false) {k}_r, coalesce(d, false) {k}_d from {k}_link l left join {k}_m using ({m}_sid)"
    V = "model_ver_"
    c["wide"] = (
        "select v.*, a.model_ver_not_valid_flag nvf, a.model_ver_busn_proc_code bp, a.model_ver_prom_actual_implm_first_dttm expl, "
        "a.model_ver_signfcnt_ctgry_code asig, a.model_ver_valid_last_rslt_name lastv, m.model_code, m.model_name, m.model_sid msid2, c.link, u.uses, "
        "coalesce(vr, false) or " + required("a.model_ver_valid_last_rslt_name") + " hvr, coalesce(vd, false) or v.model_ver_sid in (from s_ver) hvd, "
        + required("v.model_ver_montrg_last_sid") + " mon, " + required("v.model_ver_montrg_last_rslt_name")
        + " or coalesce(auto_r, false) or coalesce(manual_r, false) hmr, coalesce(auto_d, false) or coalesce(manual_d, false) or "
        "v.model_ver_sid in (from s_mon) hmd, not " + true3("a.model_ver_not_valid_flag") + " need from versions v join active a using (model_ver_sid) "
        "left join models m on m.model_sid = v.model_sid left join code c on c.model_ver_sid = v.model_ver_sid left join uses u on u.ck = upper(trim(m.model_code)) "
        "left join ve on ve.model_ver_sid = v.model_ver_sid "
        "left join auto_v on auto_v.model_ver_sid = v.model_ver_sid and auto_v.msid = v.model_ver_montrg_last_sid "
        "left join manual_v on manual_v.model_ver_sid = v.model_ver_sid and manual_v.msid = v.model_ver_montrg_last_sid")
    rules = [
        f"not {required('model_code')}", f"not {required('model_name')}", "coalesce(uses, 0) > 1", f"not {required(V + 'num')}", f"not {required(V + 'name')}",
        f"not {required(V + 'dev_start_fact_dttm')}", f"not {required(V + 'dev_end_fact_dttm')}", f"not {required('expl')}", f"not {required(V + 'owner_cont_name')}",
        f"not {required(V + 'dev_dprtmt_cont_name')}", f"not {is_na('bp')} and not {filled('bp')}", f"not {category(V + 'signfcnt_ctgry_code')}",
        f"not {required(V + 'dev_report_sid')}", f"not coalesce({required('link')}, false)", "need and not hvr", "mon and not hmr", "need and hvr and not hvd",
        "mon and hmr and not hmd", f"{category(V + 'signfcnt_ctgry_code')} and {category('asig')} and {norm(V + 'signfcnt_ctgry_code')} <> {norm('asig')}"]
    info = [x for x in card.INFO if x not in ("expl_start_dttm", "bitbucket_link", "model_sid")]
    c["card_rows"] = (
        f"select model_sid, {', '.join(info)}, {ts('expl')} expl_start_dttm, link bitbucket_link, "
        + ", ".join(f"cast(coalesce({r}, false) as integer) {n}" for n, r in zip(card.FLAGS, rules)) + " from wide")
    c["card_full"] = f"select *, cast({' + '.join(card.FLAGS)} as integer) issue_count from card_rows"
    return c


def card_sql(body):
    return ctes(**only(card_ctes(), body)) + body


def edited(df):
    """A copy of the report with some cells changed and some rows lost."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit("edit:"), "model_ver_sid")), 1, 3), 16, 10).cast("int")
    return df.filter(h % 50 != 7).withColumns({
        "model_ver_name": F.when(h % 40 == 3, F.lit(None).cast("string")).otherwise(F.col("model_ver_name")),
        "F13_DEV_REPORT": F.when(h % 60 == 5, 1 - F.col("F13_DEV_REPORT")).otherwise(F.col("F13_DEV_REPORT")),
        "model_ver_signfcnt_ctgry_code": F.when(h % 90 == 11, F.lit("A")).otherwise(F.col("model_ver_signfcnt_ctgry_code")),
    })


EDIT_SQL = ("select * exclude (model_ver_name, F13_DEV_REPORT, model_ver_signfcnt_ctgry_code), case when h % 40 = 3 then null else model_ver_name end model_ver_name, "
            "cast(case when h % 60 = 5 then 1 - F13_DEV_REPORT else F13_DEV_REPORT end as integer) F13_DEV_REPORT, "
            "case when h % 90 = 11 then 'A' else model_ver_signfcnt_ctgry_code end model_ver_signfcnt_ctgry_code from "
            "(select *, cast(('0x' || substr(md5('edit:' || model_ver_sid), 1, 3)) as integer) h from card_full) where h % 50 <> 7")
CELLS = ("model_name", "model_ver_name", "model_ver_signfcnt_ctgry_code", "bitbucket_link", *card.FLAGS, "issue_count")


def both(spark, sf):
    full = full_card(spark, sf)
    return edited(full), full


def q_coverage(spark, sf):
    return rec.key_coverage(*both(spark, sf), "model_ver_sid")


def q_cells(spark, sf):
    return rec.cell_mismatches(*both(spark, sf), "model_ver_sid", CELLS)


def q_distribution(spark, sf):
    return rec.distribution(*both(spark, sf), "model_ver_signfcnt_ctgry_code")


def q_verdict(spark, sf):
    return rec.verdict(*both(spark, sf), "model_ver_sid", CELLS, "model_ver_signfcnt_ctgry_code")


def q_invariants(spark, sf):
    return rec.report_invariants(both(spark, sf)[0], "model_ver_sid", card.FLAGS, "issue_count")


def q_flag_counts(spark, sf):
    full = card.build_card(reg(spark, sf).raw, AS_OF, written)
    return full.agg(F.count(F.lit(1)).alias("versions"), *[F.sum(f).alias(f) for f in card.FLAGS])


def rec_sql():
    edit = f"edit_ as ({EDIT_SQL})"
    base = ctes(**only(card_ctes(), "card_full")).rstrip() + f", {edit}\n"
    cells = ", ".join(f"{{'n': '{c}', 'a': cast(r.{c} as varchar), 'e': cast(c.{c} as varchar)}}" for c in CELLS)
    mism = (f"select model_ver_sid, x.n check_name, x.a actual, x.e expected from (select r.model_ver_sid, unnest([{cells}]) x from edit_ r join card_full c "
            "using (model_ver_sid)) where x.a is distinct from x.e")
    miss = "select model_ver_sid from card_full where model_ver_sid not in (select model_ver_sid from edit_)"
    distr = ("select coalesce(a.k, b.k) category, coalesce(report_count, 0) report_count, coalesce(control_count, 0) control_count from "
             "(select coalesce(model_ver_signfcnt_ctgry_code, '<NULL>') k, count(*) report_count from edit_ group by 1) a full join "
             "(select coalesce(model_ver_signfcnt_ctgry_code, '<NULL>') k, count(*) control_count from card_full group by 1) b on a.k = b.k")
    flags = " or ".join(f"coalesce({f} not in (0, 1), true)" for f in card.FLAGS)
    return {
        "card_key_coverage": base + f"select model_ver_sid, 'MISSING_FROM_REPORT' problem from ({miss})",
        "card_cell_mismatches": base + mism,
        "card_distribution": base + distr,
        "card_problems": problems_sql(),
        "card_verdict": base + f"select (select count(*) from edit_) report_rows, (select count(*) from card_full) control_rows, (select count(*) from ({miss})) missing_from_report, "
                        f"cast(0 as bigint) unexpected_in_report, (select count(*) from ({mism})) cell_mismatches, "
                        f"(select count(*) from ({distr}) where report_count <> control_count) distribution_mismatches, 'FAILED' status",
        "card_report_invariants": base + f"select 'BLANK_KEY' invariant, count(*) filter (not {required('model_ver_sid')}) \"rows\" from edit_ union all "
                                  f"select 'FLAG_NOT_0_1', count(*) filter ({flags}) from edit_ union all "
                                  f"select 'TOTAL_NOT_SUM_OF_FLAGS', count(*) filter (issue_count <> {' + '.join(card.FLAGS)}) from edit_ union all "
                                  "select 'DUPLICATE_KEY', count(*) from (select model_ver_sid from edit_ group by 1 having count(*) > 1)",
    }


# --- field statuses ---------------------------------------------------------------

def statuses(spark, sf):
    r = reg(spark, sf)
    return fields.from_tables(r.raw, r.current)


def q_field_stats(spark, sf):
    return fields.field_statistics(statuses(spark, sf))


def q_field_labels(spark, sf):
    return fields.labels_by_status(statuses(spark, sf))


def q_links(spark, sf):
    r = reg(spark, sf)
    return fields.reference_links(r.raw("sample_data"), r.raw("valid"))


def q_valid_evidence(spark, sf):
    return fields.validation_evidence(reg(spark, sf).raw("valid").filter("model_ver_sid is not null"))


@lru_cache(None)
def field_ctes():
    hv = has_value
    info = hv("sample_data_addtnl_info_txt")
    c = dict(
        mv=current("model_ver"), mo=current("model"), an=current("model_ver_anlt_dtl"), valid=duck_sql("valid"), samp=duck_sql("sample_data"), log=duck_sql("ent_param_chg"),
        v=f"select model_ver_sid, count(distinct valid_sid) validation_count, max(cast({hv('valid_rslt_name')} or {hv('valid_report_sid')} as integer)) validation_present, "
          f"max(cast({truth('valid_not_sample_data_flag')} as integer)) validation_no_sample, array_to_string(list_sort(list(distinct valid_rslt_name) "
          f"filter (valid_rslt_name is not null)), ' | ') validation_results from valid where {live()} group by 1",
        s=f"select model_ver_sid, bool_or({hv('valid_sid')} and {info}) sv, bool_or({hv('montrg_manual_rslt_sid')} and {info}) sm, "
          f"bool_or({hv('montrg_auto_rslt_sid')} and {info}) sa from samp where {live()} group by 1",
        cv=f"select ent_sid, count(*) n from log where {live()} and (starts_with(upper(ent_param_chg_sid), 'MODEL_VERSION_') or upper(ent_type_name) in ('MODEL_VERSION','MODEL_VER')) group by 1",
        cm=f"select ent_sid, count(*) n from log where {live()} and upper(ent_type_name) = 'MODEL' group by 1",
    )
    for k in ("manual", "auto"):
        m = f"montrg_{k}"
        c[f"{k}l"], c[f"{k}r"] = duck_sql(f"model_ver_x_{m}"), duck_sql(f"{m}_rslt")
        c[k] = (f"select l.model_ver_sid, bool_or({hv(m + '_rslt_name')} or {hv(m + '_rslt_report_sid')}) p, bool_or({truth(m + '_rslt_valid_not_sample_data_flag')}) x from "
                f"(select distinct model_ver_sid, {m}_sid from {k}l where {live()}) l join (select * from {k}r where {live()}) r using ({m}_sid) group by 1")

    def ok(cond, *exc):
        return f"case when coalesce({cond}, false) then 'OK' " + "".join(f"when coalesce({e}, false) then 'EXCEPTION' " for e in exc) + "else 'MISSING' end"

    na = lambda x: f"{low(x)} in ('$not_applicable$','not applicable','не применимо','неприменимо','n/a','na')"
    fs = lambda x: f"case when coalesce({na(x)}, false) then 'EXCEPTION' when {hv(x)} then 'OK' else 'MISSING' end"
    m, a, an = "mv.model_ver_", "an.model_ver_", "an"
    novalid, excl = truth(a + "not_valid_flag"), hv(m + "montrg_auto_exclude_reason_array")
    exprs = [
        ok(f"{hv('mo.model_code')} and {hv('mo.model_name')}"), ok(hv(m + "crtn_dttm")),
        ok(hv(f"coalesce({a}prom_actual_implm_first_dttm, {a}prom_implm_first_dttm)")),
        ok(hv(f"coalesce({a}prom_actual_expl_output_dttm, {a}prom_expl_output_dttm)"), truth(a + "prom_expl_flag")),
        ok(f"{hv(m + 'owner_cont_name')} and {hv(m + 'owner_dprtmt_name')} and {hv(m + 'owner_block_name')}"),
        ok(f"{hv(m + 'dev_dprtmt_cont_name')} and {hv(m + 'dev_dprtmt_name')} and {hv(m + 'dev_block_name')}"),
        ok(f"{hv(a + 'employer_block_name')} and {hv(a + 'employer_dprtmt_name')}"), fs(a + "risk_sgmnt_name"), fs(a + "busn_proc_code"),
        fs(f"coalesce({a}signfcnt_ctgry_code, {m}signfcnt_ctgry_code)"),
        ok(f"{hv(m + 'dev_report_sid')} or {hv(m + 'other_docs_sid')} or {hv('mo.model_other_docs_sid')}", na(m + "other_docs_sid"), na("mo.model_other_docs_sid")),
        ok(f"{hv(m + 'repstry_link_txt')} or {hv(m + 'implm_repstry_link_txt')}", f"{hv(m + 'repstry_non_link_reason_name')} or {hv(m + 'repstry_non_link_reason_cmnt_txt')}"),
        ok("v.validation_present = 1", novalid), ok("manual.p"), ok("auto.p", excl), ok("sv", f"{novalid} or coalesce(v.validation_no_sample, 0) = 1"),
        ok("sm", "manual.x"), ok("sa", f"coalesce(auto.x, false) or {excl}"), ok("coalesce(cv.n, 0) + coalesce(cm.n, 0) > 0"), "'NOT_CHECKED'",
    ]
    cols = ", ".join(f"{e} status_{n}" for n, e in zip(fields.FIELDS, exprs))
    c["st"] = (f"select mv.model_sid, mv.model_ver_sid, {cols} from mv join mo on mo.model_sid = mv.model_sid join an on an.model_ver_sid = mv.model_ver_sid "
               "left join v on v.model_ver_sid = mv.model_ver_sid left join manual on manual.model_ver_sid = mv.model_ver_sid left join auto on auto.model_ver_sid = mv.model_ver_sid "
               f"left join s on s.model_ver_sid = mv.model_ver_sid left join cv on cv.ent_sid = mv.model_ver_sid left join cm on cm.ent_sid = mv.model_sid where {truth(a + 'prom_expl_flag')}")
    return c


def fsql(body):
    return ctes(**only(field_ctes(), body)) + body


def field_oracles():
    pairs = ", ".join(f"{{'f': '{n}', 's': status_{n}}}" for n in fields.FIELDS)
    items = f"select model_ver_sid, [{pairs}] i from st"

    def names(s):
        return f"array_to_string(list_transform(list_filter(i, lambda x: x.s = '{s}'), lambda x: x.f), '; ')"

    def size(s):
        return f"cast(len(list_filter(i, lambda x: x.s = '{s}')) as integer)"

    links = " union ".join(
        f"(select model_ver_sid, '{k}' kind, sample_data_addtnl_info_txt as \"value\" from samp where {live()} and {has_value(c)} and sample_data_addtnl_info_txt is not null and model_ver_sid is not null)"
        for k, c in (("validation_data", "valid_sid"), ("manual_monitoring_data", "montrg_manual_rslt_sid"), ("auto_monitoring_data", "montrg_auto_rslt_sid")))
    return {
        "field_statuses": fsql("select * from st"),
        "field_statistics": fsql(
            f"select x.f field, count(*) versions, count(distinct model_sid) models, count(*) filter (x.s = 'OK') ok, count(*) filter (x.s = 'MISSING') violations, "
            "count(*) filter (x.s in ('EXCEPTION','NOT_CHECKED')) not_applicable, round(100.0 * count(*) filter (x.s = 'MISSING') / "
            "nullif(count(*) filter (x.s not in ('EXCEPTION','NOT_CHECKED')), 0), 2) violation_pct "
            f"from (select model_sid, unnest([{pairs}]) x from st) group by 1"),
        "field_labels": fsql(
            f"select model_ver_sid, {names('MISSING')} missing_fields, {names('EXCEPTION')} exception_fields, {names('NOT_CHECKED')} unchecked_fields, "
            f"{size('MISSING')} missing_count, {size('OK')} ok_count, case when {size('MISSING')} > 0 then 'MISSING' when {size('NOT_CHECKED')} > 0 then 'NOT_CHECKED' else 'OK' end overall_status from ({items})"),
        "field_reference_links": fsql(
            links + f" union (select model_ver_sid, 'validation_report' kind, valid_report_sid as \"value\" from valid where {live()} and valid_report_sid is not null and model_ver_sid is not null)"),
        "field_validation_evidence": fsql("select * from v where model_ver_sid is not null"),
    }


def q_problems(spark, sf):
    """History with start days cut to years and versions' production records joined under their model, so that states collide."""
    def raw(name):
        d = reg(spark, sf).raw(name)
        if name == "model_ver_prom":
            d = d.withColumn("model_ver_sid", F.when(F.col("model_ver_sid").cast("int") % 40 != 0, (F.col("model_ver_sid").cast("int") % 40).cast("string")))
        return d.withColumn("start_dt", F.trunc("start_dt", "YEAR")) if "start_dt" in d.columns else d

    return card.card_problems(raw, AS_OF)


def problems_sql():
    parts = []
    for name, (keys, nullable, fields) in card.CARD_STATES.items():
        log = name == "ent_param_chg"
        order = "start_dttm desc, ctl_datechange desc nulls last" if log else "start_dt desc, ctl_datechange desc nulls last"
        inside = (f"start_dttm <= timestamp '{AS_OF} 23:59:59' and coalesce(end_dttm >= timestamp '{AS_OF} 23:59:59', true) and upper(trim(ent_type_name)) = 'MODEL_VERSION' and upper(trim(ent_param_chg_sid)) = '{card.CODE_PARAMETER}'"
                  if log else f"start_dt <= date '{AS_OF}' and coalesce(end_dt >= date '{AS_OF}', true)")
        names = ", ".join(keys)
        src = f"({duck_sql(name)})"
        if name == "model_ver_prom":
            src = f"(select * replace (case when model_ver_sid::int % 40 <> 0 then (model_ver_sid::int % 40)::varchar end as model_ver_sid) from {src})"
        if not log:
            src = f"(select * replace (cast(date_trunc('year', start_dt) as date) as start_dt) from {src})"
        rows = f"select distinct {', '.join([*keys, *fields])}, ctl_action from (select *, dense_rank() over (partition by {names} order by {order}) r from {src} where {inside}) where r = 1"
        if name == "model_ver_prom":
            links = f"select distinct model_ver_sid, model_ver_prom_repstry_commit_link_txt link from ({rows}) where {live()} and {required('model_ver_sid')}"
        empty = " or ".join(f"not coalesce({required(k)}, false)" for k in keys if k not in nullable)
        parts.append(f"(select '{name}' source_table, concat_ws('|', {names}) entity_key, case when {empty} then 'EMPTY_KEY' else 'AMBIGUOUS_STATE' end problem from ({rows}) group by {names} having count(*) > 1 or {empty})")
    parts.append(f"(select 'model_ver_prom' source_table, model_ver_sid entity_key, 'SEVERAL_COMMIT_LINKS' problem from ({links}) group by 2 having count(distinct link) > 1)")
    return " union all ".join(parts)


QUERIES = {
    "card_problems": q_problems,
    "card_flags": q_card, "card_flag_counts": q_flag_counts, "card_key_coverage": q_coverage, "card_cell_mismatches": q_cells,
    "card_distribution": q_distribution, "card_verdict": q_verdict, "card_report_invariants": q_invariants,
    "field_statuses": statuses, "field_statistics": q_field_stats, "field_labels": q_field_labels, "field_reference_links": q_links,
    "field_validation_evidence": q_valid_evidence,
}


def ORACLE():
    return {
        "card_flags": card_sql("select * from card_full"),
        "card_flag_counts": card_sql("select count(*) versions, " + ", ".join(f"cast(sum({f}) as bigint) {f}" for f in card.FLAGS) + " from card_full"),
        **rec_sql(), **field_oracles(),
    }
