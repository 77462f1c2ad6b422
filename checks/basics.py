"""Predicates, dates, states, joins, windows, sources, profile and probe with their DuckDB twins."""

from __future__ import annotations

from functools import lru_cache

from modelwarden.demo import AS_OF, Registry, duck_sql
from modelwarden.functions import dates as dt
from modelwarden.functions import hashing as hs
from modelwarden.functions import predicates as pr
from modelwarden.operators import measures as me
from modelwarden.operators import ordered
from modelwarden.operators import probe, profile, relate
from modelwarden.operators import state as st
from modelwarden.plans import development as dev
from modelwarden.plans import portfolio as pf
from modelwarden.sources import catalog, contract, files
from pyspark.sql import functions as F

from .development import only
from .sqlkit import (
    D, END, art, blank, category, ctes, current, falsehood, filled, has_value, is_na, like, live, location, low, norm, placeholder, plain,
    real, required, truth, ts, written,
)
from .sqlkit import clean as clean_sql

FLAGS = ("blank", "artifact_missing", "placeholder", "filled", "required", "truth", "falsehood", "is_na", "has_location", "link_value",
         "valid_category", "uuid_list", "numeric_parseable", "has_value")


def reg(s, f):
    return Registry.of(s, f)


def q_predicates(s, f):
    d = reg(s, f).raw("text_probe").groupBy("raw").agg(F.count(F.lit(1)).alias("rows"))
    return d.select("raw", "rows", *[getattr(pr, n)("raw").alias(n) for n in FLAGS], pr.norm("raw").alias("norm"), pr.clean_dim("raw").alias("clean_dim"),
                    pr.contains_host("raw", "host.example").alias("contains_host"), pr.field_status("raw").alias("field_status"))


def q_dates(s, f):
    d = reg(s, f).raw("text_probe").groupBy("date_text").agg(F.count(F.lit(1)).alias("rows"))
    parsed = dt.parse_ts("date_text")
    return plain(d.select("date_text", "rows", parsed.alias("parsed"), dt.real_date(parsed).alias("real_date")))


def q_intervals(s, f):
    d = reg(s, f).raw("text_probe")
    return d.select(
        "row_sid", F.date_format(dt.cap_open_end("end_day", AS_OF), "yyyy-MM-dd HH:mm:ss").alias("capped"), dt.interval_inverted("start_day", "end_day").alias("inverted"),
        F.round(dt.duration_days("end_day", "start_day"), 6).alias("days"), F.round(dt.hours_between("end_day", "start_day"), 6).alias("hours"),
        dt.days_late("end_day", "start_day").alias("days_late"))


def q_age(s, f):
    d = reg(s, f).current("valid")
    return plain(d.select("valid_sid", dt.age_anchor("valid_stts_name", "valid_crtn_dttm", "valid_start_fact_dttm").alias("anchor")))


def q_unparsed(s, f):
    return dt.unparsed(reg(s, f).raw("text_probe"), ["date_text"]).select("row_sid", "date_text")


def q_scopes(s, f):
    d = reg(s, f).current("model_ver").select("model_ver_sid", "model_ver_stts_name")
    return relate.union_named(*[
        pr.status_scope(d, "model_ver_stts_name", inc, exc).select(F.lit(n).alias("scope"), "model_ver_sid")
        for n, inc, exc in (
            ("active", None, pf.CLOSED), ("evidence", pf.EVIDENCE_DUE, pf.CLOSED), ("deploy", pf.DEPLOY, None), ("validation", pf.VALIDATION_DUE, pf.CLOSED),
            ("development", dev.DEV_STATUS, dev.CLOSED_MODEL_STATUS), ("started", dev.STARTED_STATUS, dev.CLOSED_MODEL_STATUS), ("gate", dev.GATE_STATUS, dev.CLOSED_MODEL_STATUS))
    ]).groupBy("scope").agg(F.count(F.lit(1)).alias("versions"))


def q_mask(s, f):
    d = reg(s, f).base("customer")
    return d.select("c_custkey", hs.mask_value("c_name").alias("masked"), hs.pseudonymise_sha(["c_name", "c_mktsegment"]).alias("person"),
                    hs.bucket(["c_custkey"], "s1").alias("bucket"))


def q_pseudonym(s, f):
    d = reg(s, f).base("customer")
    return d.select(hs.pseudonymise(["c_name"]).alias("k")).agg(F.countDistinct("k").alias("people"), F.count(F.lit(1)).alias("rows"))


def q_personal(s, f):
    return hs.drop_personal_columns(reg(s, f).raw("model_ver").select("model_ver_sid", "model_ver_owner_cont_name", "model_ver_dev_dprtmt_cont_name", "model_ver_stts_name"))


def q_map(s, f):
    d = reg(s, f).current("model_ver")
    return d.groupBy(pr.map_values("model_ver_stts_name", {"MODEL_VERSION_BACKLOG": "Backlog", "MODEL_VERSION_DEVELOPMENT": "In work"}).alias("label")).agg(
        F.count(F.lit(1)).alias("versions"))


# --- states --------------------------------------------------------------------

MV = ["model_ver_sid", "model_ver_stts_name", "start_dt"]


def q_state(current):
    def run(s, f):
        return st.read_state(reg(s, f).raw("valid"), ["valid_sid"], ["model_ver_sid", "valid_stts_name", "valid_rslt_name"], AS_OF, current=current)
    return run


def tied(s, f):
    """Versions of a model share creation days, so that states collide."""
    d = reg(s, f).raw("model_ver").filter("model_sid is not null")
    return d.select("model_sid", F.col("start_dt"), "ctl_action", F.col("model_ver_stts_name").alias("state")).withColumn(
        "start_dt", F.trunc("start_dt", "YEAR"))


def q_ambiguous(s, f):
    return st.ambiguous_keys(st.state_candidates(tied(s, f), ["model_sid"], ["state"], AS_OF), ["model_sid"])


def q_timestamp_grain(s, f):
    return plain(st.valid_at(reg(s, f).raw("ent_param_chg"), "2007-12-20", "start_dttm", "end_dttm").select("event_sid", "start_dttm"))


def versions(s, f, model_ver=None):
    r = reg(s, f)
    flag = r.current("model_ver_anlt_dtl").select("model_ver_sid", "model_ver_prom_expl_flag")
    return (model_ver or r.current("model_ver")).select("model_sid", "model_ver_sid", "model_ver_stts_name", "model_ver_crtn_dttm").join(flag, "model_ver_sid", "left")


def q_versions(mode):
    return lambda s, f: st.select_versions(versions(s, f), AS_OF, mode, "CANCEL|CANCELED|ARCHIV|REJECT", check=False).select("model_sid", "model_ver_sid")


def q_certainty(s, f):
    v = reg(s, f).current("valid").filter("model_ver_sid is not null").select("valid_sid", "model_ver_sid", "valid_end_fact_dttm", "valid_rslt_name")
    dated = dt.real_date("valid_end_fact_dttm") & (F.col("valid_end_fact_dttm") <= dt.as_of_end(AS_OF))
    return st.latest_with_certainty(v, "model_ver_sid", "valid_end_fact_dttm", F.coalesce(dated, F.lit(False)), "is_latest")


def q_red(s, f):
    r = reg(s, f)
    from modelwarden.plans.development import completed_validations

    done = completed_validations(r.current("valid")).filter("model_ver_sid is not null").select("valid_sid", "model_ver_sid", "valid_end_fact_dttm", "valid_rslt_name")
    dated = F.coalesce(dt.real_date("valid_end_fact_dttm") & (F.col("valid_end_fact_dttm") <= dt.as_of_end(AS_OF)), F.lit(False))
    flagged = st.latest_with_certainty(done, "model_ver_sid", "valid_end_fact_dttm", dated, "is_latest")
    live_versions = r.current("model_ver_anlt_dtl").filter(pr.truth("model_ver_prom_expl_flag")).select("model_ver_sid").distinct()
    return flagged.filter(pr.status_like("valid_rslt_name", "КРАСН|RED")).join(live_versions, "model_ver_sid", "left_semi").select("valid_sid", "model_ver_sid", "is_latest")


def q_attempts(s, f):
    from modelwarden.plans.audit import attempt_statistics

    return attempt_statistics(reg(s, f).current("valid"), written)


def q_summary_sheet(s, f):
    from modelwarden.plans.audit import summary_sheet

    from .development import detail_all, slices
    kept = slices(s, f, ("model_sid", "model_ver_crtn_dttm"))  # the perimeter reads the versions too
    v = versions(s, f, kept["model_ver"]).filter(pr.truth("model_ver_prom_expl_flag")).select("model_ver_sid", "model_sid")
    return summary_sheet(v, detail_all(s, f, kept=kept), reg(s, f).current("valid"), list(range(1, 29)), written)


def q_disagreement(s, f):
    r = reg(s, f)
    a = r.current("model_ver_anlt_dtl").select("model_ver_sid", F.col("model_ver_stts_name").alias("analytics_status"))
    j = r.current("model_ver").select("model_ver_sid", "model_ver_stts_name").join(a, "model_ver_sid")
    return j.filter(F.col("analytics_status").isNotNull() & ~F.col("analytics_status").eqNullSafe(F.col("model_ver_stts_name"))).agg(F.count(F.lit(1)).alias("versions"))


# --- joins, sets, measures ---------------------------------------------------------

def q_closure(s, f):
    r = reg(s, f)
    seeds = r.current("model").filter(F.col("model_subtype_name") == "BUILDING").select("model_sid")
    return relate.key_closure(seeds, hops(r), "model", written)


def hops(r):
    return [
        ("model", r.raw("model_ver"), "model_sid", "model_ver_sid", "version"), ("version", r.raw("model_ver_prom"), "model_ver_sid", "model_ver_prom_sid", "prom"),
        ("version", r.raw("valid"), "model_ver_sid", "valid_sid", "valid"), ("version", r.raw("model_ver_x_montrg_auto"), "model_ver_sid", "montrg_auto_sid", "auto"),
        ("auto", r.raw("montrg_auto_rslt"), "montrg_auto_sid", "montrg_auto_rslt_sid", "auto_result"),
        ("valid", r.raw("sample_data"), "valid_sid", "sample_data_sid", "sample"), ("auto_result", r.raw("sample_data"), "montrg_auto_rslt_sid", "sample_data_sid", "sample"),
    ]


KINDS = {"model_sid": "model", "model_ver_sid": "version", "valid_sid": "valid", "montrg_auto_sid": "auto", "sample_data_sid": "sample"}


def seeds(r):
    """Models of one subtype, about a fifth of all."""
    return r.current("model").filter("model_subtype_name = 'BUILDING'").select("model_sid")


def probe_tables(r):
    tables = {
        "t_valid": (r.current("valid").select("valid_sid", "model_ver_sid", "valid_red_zone_comt_rsk_decsn_link_txt", "valid_rslt_name"), ["valid_sid"]),
        "t_metric": (r.current("metric").select("metric_sid", "sample_data_sid", "metric_name", "metric_val"), ["metric_sid"]),
        "t_model_ver": (r.current("model_ver").select("model_ver_sid", "model_sid", "model_ver_repstry_link_txt", "model_ver_repstry_commit_sid"), ["model_ver_sid"]),
        "t_genai": (r.current("genai").select("genai_sid", "genai_stts_name"), ["genai_sid"]),
    }
    return tables


def q_coverage(s, f):
    r = reg(s, f)
    return probe.coverage(s, probe_tables(r), relate.key_closure(seeds(r), hops(r), "model", written), KINDS)


def q_scoped(s, f):
    r = reg(s, f)
    return relate.scoped_counts(probe_tables(r), relate.key_closure(seeds(r), hops(r), "model", written), KINDS)


def long(s, f):
    r = reg(s, f)
    return relate.union_named(*[probe.to_long(d, n) for n, (d, _) in probe_tables(r).items()])


def q_doc_links(s, f):
    r = reg(s, f)
    return probe.link_hits(probe.to_long(r.base("pages").select("page_id", "url"), "pages"), 20)


def q_link_rows(s, f):
    r = reg(s, f)
    return probe.link_rows(r.base("pages").select("page_id", "url"), "pages")


def q_enough(s, f):
    """Null-safe key handling, key overlap and marker flags in one result."""
    r = reg(s, f)
    v, sm = r.current("valid"), r.current("sample_data")
    flags = relate.presence_flag(v, "model_ver_sid", pr.truth("valid_alt_flag"), "any_alt").filter("model_ver_sid is not null")
    mark = relate.marker(sm, "model_ver_sid", F.col("model_ver_sid").isNotNull() & pr.has_location("sample_data_addtnl_info_txt"), "located")
    return relate.left_with_defaults(flags, mark, "model_ver_sid", {"located": 0})


def q_resolved(s, f):
    r = reg(s, f)
    d = relate.resolve_parent(r.current("sample_data").select("sample_data_sid", "model_ver_sid", "valid_sid"), r.current("valid"), "valid_sid", "model_ver_sid", "version")
    return d.select("sample_data_sid", "version")


def q_overlap(s, f):
    r = reg(s, f)
    return relate.key_overlap(r.raw("valid"), r.raw("sample_data"), ["model_ver_sid", "valid_sid"])


def q_first(s, f):
    return relate.first_by(reg(s, f).base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"])


def q_residual(s, f):
    r = reg(s, f)
    log = r.raw("ent_param_chg")
    about = F.upper("ent_param_chg_sid").startswith("MODEL_VERSION_") | F.upper("ent_type_name").isin("MODEL_VERSION", "MODEL_VER")
    return relate.join_where(r.current("model_ver").select("model_ver_sid"), log, "model_ver_sid", "ent_sid", F.coalesce(about, F.lit(False))).select("model_ver_sid", "event_sid")


def q_set_flow(s, f):
    """Semi, anti and union with missing columns account for every row."""
    r = reg(s, f)
    v, keys = r.current("valid").select("valid_sid", "model_ver_sid"), r.current("model_ver").select("model_ver_sid")
    a = relate.within(v, keys, "model_ver_sid").select("valid_sid", F.lit(1).alias("known"))
    b = relate.outside(v, keys, "model_ver_sid").select("valid_sid")
    return relate.union_named(a, b, allow_missing=True).groupBy("known").agg(F.count(F.lit(1)).alias("rows"))


def q_missingness(s, f):
    d = reg(s, f).current("model_ver")
    return me.missingness(d, ["model_sid", "model_ver_method_name", "model_ver_data_type_name", "model_ver_dev_report_sid", "model_ver_tgt_txt"])


def q_quantiles(rule):
    def run(s, f):
        d = reg(s, f).base("lineitem").select("l_returnflag", "l_extendedprice")
        q = ordered.exact_quantiles(d, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, rule=rule)
        return q.select("l_returnflag", *[F.round(p, 6).alias(p) for p in ("p10", "p50", "p90")], "n")
    return run


def q_row_number(s, f):
    d = reg(s, f).base("orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    b = ordered.balanced_buckets(d, ["o_orderstatus"], "o_totalprice")
    return ordered.bucketed_row_number(b, ["o_orderstatus"], "_b", [F.col("o_totalprice"), F.col("o_orderkey")]).select("o_orderstatus", "o_orderkey", "rank")


def q_top(s, f):
    d = reg(s, f).base("orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return me.top_per_group(d, ["o_orderstatus"], [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 5)


def q_seeded(s, f):
    return me.seeded_limit(reg(s, f).base("orders").select("o_orderkey"), hs.digest(["o_orderkey"], "lim"), ["o_orderkey"], 25)


def q_priority(s, f):
    v = reg(s, f).current("valid").filter("model_ver_sid is not null")
    return st.latest_by_priority(v, "model_ver_sid", ["valid_end_fact_dttm", "valid_start_fact_dttm", "valid_crtn_dttm"], "valid_sid").select("model_ver_sid", "valid_sid")


def q_approx(s, f):
    """Whether each sketched quantile lies within its stated rank error (1 / accuracy of the group)."""
    d, accuracy = reg(s, f).base("lineitem"), 100
    q = me.approx_duration_quantiles(d, F.col("l_returnflag"), F.col("l_extendedprice"), 0.9, accuracy).withColumnRenamed("dim_1_value", "l_returnflag")
    at = d.join(q, "l_returnflag").groupBy("l_returnflag", "denominator").agg(
        F.avg((F.col("l_extendedprice") < F.col("metric_value")).cast("double")).alias("below"), F.avg((F.col("l_extendedprice") <= F.col("metric_value")).cast("double")).alias("upto"))
    return at.select("l_returnflag", "denominator", ((F.col("below") <= 0.9 + 1 / accuracy) & (F.col("upto") >= 0.9 - 1 / accuracy)).alias("holds"))


def q_approx_distinct(s, f):
    """Whether the sketched number of keys lies within three standard errors (5 % each) of the exact one."""
    d, keys = reg(s, f).base("lineitem"), ["l_orderkey", "l_linenumber"]
    exact = profile.table_summary(d, keys, "lineitem", exact=True).select("source_table", F.col("distinct_keys").alias("exact"))
    near = F.abs(F.col("distinct_keys") - F.col("exact")) <= F.col("exact") * 0.15
    return profile.table_summary(d, keys, "lineitem").join(exact, "source_table").select("source_table", "key_columns", "source_row_count", near.alias("holds"))


# --- sources --------------------------------------------------------------------------

def q_csv(s, f):
    path = files.scratch_folder(s) + "/csv"
    files.write_csv_report(reg(s, f).base("orders").select("o_orderkey", "o_orderstatus"), path)
    return files.scan_csv(s, path, "o_orderkey bigint, o_orderstatus string")


def q_json(s, f):
    path = files.scratch_folder(s) + "/log"
    from .evaluation import trials

    t = trials(s, f).select(F.to_json(F.struct("fidelity", "method", F.col("features").alias("subset"), "n_features", "valid_metric")).alias("value"))
    torn = s.range(3).select(F.lit('{"fidelity": "sea').alias("value"))
    t.unionByName(torn).write.text(path)
    return files.read_json_lines(s, path).groupBy("fidelity").agg(F.count(F.lit(1)).alias("trials"), F.sum("n_features").alias("features"))


def q_saved(s, f):
    path = files.scratch_folder(s) + "/out"
    r = reg(s, f)
    d = r.current("valid").select(F.lit(1).alias("query_id"), F.col("valid_sid").alias("source_entity_sid"))
    files.save_results(me.dist(r.current("valid"), pr.dim("valid_rslt_name")), d, path)
    return files.scan_parquet(s, f"{path}/detail").groupBy("query_id").agg(F.count(F.lit(1)).alias("rows"))


def q_roles_written(s, f):
    path = files.scratch_folder(s) + "/roles"
    from .modelling import grouped

    files.write_parquet(grouped(s, f), path, partition_by=["role"])
    return s.read.parquet(path).groupBy("role").agg(F.count(F.lit(1)).alias("rows"))


def q_export(s, f):
    """All trials, written in parts of 1 000 rows and read again."""
    from .evaluation import trials

    path = files.scratch_folder(s) + "/export"
    files.export_in_parts(trials(s, f).select("trial_id", "features"), path, 1000)
    return s.read.option("header", True).option("escape", '"').schema("trial_id bigint, features string").csv(path)


_AUDIT: dict = {}


def audit_frames(s, f, *names):
    """The named frames of one folder's audit (or all), what they share written once per session."""
    from modelwarden.plans.audit import FRAMES, run_audit
    from modelwarden.plans.development import COLUMNS

    key = (s.sparkContext.applicationId, f, names)
    if key not in _AUDIT:
        _AUDIT.clear()
        r = reg(s, f)
        current = lambda t: r.kept(t, COLUMNS[t], written) if t in COLUMNS else r.current(t)
        _AUDIT[key] = run_audit(current, r.raw, AS_OF, hold=written, names=names or FRAMES)
    return _AUDIT[key]


def q_report(s, f):
    return plain(audit_frames(s, f, "version_report")["version_report"].select(
        "model_ver_sid", "model_sid", "model_ver_stts_name", "failed_controls", "failed_high_controls", "change_count", "changed_parameters", "last_change"))


def q_diagnostics(s, f):
    return audit_frames(s, f, "run_diagnostics")["run_diagnostics"].select("versions", "models", "status_disagreement")


def q_audit_rows(s, f):
    """Rows of every frame of the audit."""
    frames = audit_frames(s, f)
    return relate.union_named(*[d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("frame"), "rows") for n, d in frames.items()])


def q_contract(s, f):
    r = reg(s, f)
    frames = {"model": r.raw("model"), "valid": r.raw("valid")}
    return contract.contract_report(s, frames, {"model": ["model_sid", "model_price"], "valid": ["VALID_SID", "valid_colour"], "absent": ["x"]})


QUERIES = {
    "text_predicates": q_predicates, "date_parse": q_dates, "date_intervals": q_intervals, "date_age_anchor": q_age, "date_unparsed": q_unparsed,
    "text_status_scopes": q_scopes, "text_mask": q_mask, "text_pseudonymise": q_pseudonym, "text_drop_personal": q_personal, "text_map_values": q_map,
    "state_take_latest": lambda s, f: plain(st.take_latest(reg(s, f).raw("model_ver"), ["model_ver_sid"], ["start_dt"]).select(*MV)),
    "state_tombstone_after": lambda s, f: plain(st.current_slice(reg(s, f).raw("model_ver"), ["model_ver_sid"], AS_OF).select(*MV)),
    "state_tombstone_before": lambda s, f: plain(st.current_slice(reg(s, f).raw("model_ver"), ["model_ver_sid"], AS_OF, "before").select(*MV)),
    "state_prefer_open": lambda s, f: plain(st.current_rows(reg(s, f).raw("model_ver"), ["model_ver_sid"], AS_OF).select(*MV)),
    "state_read": q_state(True), "state_events": q_state(False), "state_ambiguous": q_ambiguous, "state_timestamp_grain": q_timestamp_grain,
    "state_latest_by_priority": q_priority,
    "state_join_latest": lambda s, f: st.join_latest(reg(s, f).current("model_ver").select("model_ver_sid"), reg(s, f).raw("valid"), "model_ver_sid",
                                                      ["start_dt", F.col("valid_sid").desc(), F.col("ctl_loading").desc()], ["valid_sid"]),
    "state_versions_latest": q_versions("latest_created"), "state_versions_all": q_versions("current_all"), "state_versions_production": q_versions("latest_production"),
    "state_version_problems": lambda s, f: st.version_problems(versions(s, f), AS_OF).groupBy("problem").agg(F.count(F.lit(1)).alias("rows")),
    "state_certainty": lambda s, f: plain(q_certainty(s, f)), "state_duplicates": lambda s, f: st.duplicate_keys(reg(s, f).base("lineitem"), ["l_orderkey", "l_linenumber"]),
    "state_display": lambda s, f: plain(st.latest_display(reg(s, f).raw("valid").select("valid_sid", "start_dt", "ctl_loading", "valid_rslt_name"), ["valid_sid"])),
    "audit_red_in_production": q_red, "audit_attempts": q_attempts, "audit_version_report": q_report, "audit_run_diagnostics": q_diagnostics, "audit_frame_rows": q_audit_rows,
    "audit_summary_sheet": q_summary_sheet, "audit_status_disagreement": q_disagreement,
    "join_closure": q_closure, "join_flags": q_enough, "join_resolve_parent": q_resolved, "join_key_overlap": q_overlap, "join_first_by": q_first,
    "join_residual": q_residual, "join_set_flow": q_set_flow,
    "measure_missingness": q_missingness, "measure_quantile_disc": q_quantiles("disc"), "measure_quantile_nearest": q_quantiles("nearest"),
    "measure_quantile_linear": q_quantiles("linear"), "measure_approx_quantile": q_approx, "window_row_number": q_row_number, "window_top_n": q_top,
    "window_seeded_limit": q_seeded,
    "profile_summary": lambda s, f: profile.table_summary(reg(s, f).base("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem", exact=True),
    "profile_summary_approx": q_approx_distinct,
    "profile_columns": lambda s, f: profile.column_profile(reg(s, f).raw("text_probe").select("raw", F.col("date_text").alias("seen_date"), F.col("row_sid").alias("note_txt")), "text_probe").drop("approx_distinct_count"),
    "profile_top_values": lambda s, f: profile.top_values(reg(s, f).raw("model_ver"), "model_ver", ["model_ver_stts_name", "model_ver_dev_dprtmt_name", "model_ver_repstry_link_txt"], 4),
    "profile_masked_rows": lambda s, f: profile.masked_rows(reg(s, f).raw("busn_task"), "busn_task", ["busn_task_name", "busn_task_claim_descr_txt"], 10),
    "probe_first_values": lambda s, f: probe.first_values(long(s, f), 10), "probe_link_hits": lambda s, f: probe.link_hits(long(s, f), 15),
    "probe_page_links": q_doc_links, "probe_link_rows": q_link_rows, "probe_scoped_rows": q_scoped, "probe_coverage": q_coverage,
    "source_csv": q_csv, "source_json_lines": q_json, "source_saved_detail": q_saved, "source_partitioned_roles": q_roles_written,
    "source_export": q_export,
    "source_inventory": lambda s, f: files.parquet_inventory(s, f"{f}/lineitem.parquet").drop("bytes"),
    "source_glob": lambda s, f: files.scan_parquet(s, f"{f}/order*.parquet").select("o_orderkey"),
    "source_select_existing": lambda s, f: contract.select_existing(reg(s, f).base("orders"), ["o_orderkey", "o_colour", "o_orderstatus"]),
}


@lru_cache(None)
def base_ctes():
    c = {t: current(t) for t in ("model_ver", "valid", "sample_data", "metric", "model", "genai", "model_ver_anlt_dtl")}
    c = {f"k_{k}": v for k, v in c.items()}
    for t in ("model_ver", "valid", "sample_data", "text_probe", "ent_param_chg", "model_ver_prom", "model_ver_x_montrg_auto", "montrg_auto_rslt", "busn_task"):
        c[f"r_{t}"] = duck_sql(t)
    c["ver"] = ("select v.model_sid, v.model_ver_sid, v.model_ver_stts_name, v.model_ver_crtn_dttm, a.model_ver_prom_expl_flag from k_model_ver v left join k_model_ver_anlt_dtl a using (model_ver_sid)")
    c["opened"] = f"select * from ver where not {like('model_ver_stts_name', 'CANCEL|ARCHIV|REJECT')}"
    c["done"] = (f"select * from k_valid where not {like('valid_stts_name', 'CANCEL|NOT_NEEDED|SUSPENDED|REJECT')} and ({like('valid_stts_name', 'DONE|COMPLETE|RESULTS_APPROVE')} or {real('valid_end_fact_dttm')})")
    dated = f"({real('valid_end_fact_dttm')} and coalesce(valid_end_fact_dttm <= {END}, false))"
    for name, src in (("cert", "k_valid"), ("certc", "done")):
        c[name] = (f"select valid_sid, model_ver_sid, valid_end_fact_dttm, valid_rslt_name, case when u = 0 and n = 1 then d and valid_end_fact_dttm = m end is_latest from (select *, count(*) filter (d and valid_end_fact_dttm = m) over "
                   f"(partition by model_ver_sid) n from (select *, {dated} d, count(*) filter (not {dated}) over (partition by model_ver_sid) u, max(case when {dated} then valid_end_fact_dttm end) over (partition by model_ver_sid) m from {src} "
                   "where model_ver_sid is not null))")
    c["att"] = (f"select model_ver_sid, valid_sid, coalesce(valid_start_fact_dttm, valid_crtn_dttm) s, valid_end_fact_dttm e, cast(not {blank('valid_dev_return_reason_txt')} as integer) rr, "
                f"cast({like('valid_stts_name', 'DONE_NEGATIVE')} or {like('valid_rslt_name', 'КРАСН|Ж[ЕЁ]ЛТ|RED|YELLOW')} as integer) ng from k_valid where model_ver_sid is not null")
    c["att2"] = "select *, lead(s) over (partition by model_ver_sid order by s nulls first, valid_sid) nx from att"
    c["attempts"] = ("select model_ver_sid, count(distinct valid_sid) validation_records, cast(sum(rr) as bigint) return_records, cast(sum(ng) as bigint) negative_records, count(d) rework_intervals, round(sum(d), 2) rework_days from "
                     "(select *, case when rr = 1 and e is not null and nx >= e then (epoch(nx) - epoch(e)) / 86400.0 end d from att2) group by 1")

    def closure(seed):
        return {
            "c0": seed, "c1": "select distinct model_ver_sid k from r_model_ver where model_sid in (select k from c0)",
            "c2": "select distinct model_ver_prom_sid k from r_model_ver_prom where model_ver_sid in (select k from c1)",
            "c3": "select distinct valid_sid k from r_valid where model_ver_sid in (select k from c1)",
            "c4": "select distinct montrg_auto_sid k from r_model_ver_x_montrg_auto where model_ver_sid in (select k from c1)",
            "c5": "select distinct montrg_auto_rslt_sid k from r_montrg_auto_rslt where montrg_auto_sid in (select k from c4)",
            "c6": "select distinct sample_data_sid k from r_sample_data where valid_sid in (select k from c3) or montrg_auto_rslt_sid in (select k from c5)",
        }
    c |= closure("select model_sid k from k_model where model_subtype_name = 'BUILDING'")
    cols = {"t_valid": ("k_valid", "valid_sid", "model_ver_sid", "valid_red_zone_comt_rsk_decsn_link_txt", "valid_rslt_name"), "t_metric": ("k_metric", "metric_sid", "sample_data_sid", "metric_name", "metric_val"),
            "t_model_ver": ("k_model_ver", "model_ver_sid", "model_sid", "model_ver_repstry_link_txt", "model_ver_repstry_commit_sid"), "t_genai": ("k_genai", "genai_sid", "genai_stts_name")}
    c["lng"] = " union all ".join(f"select '{t}' table_name, '{x}' column_name, {x} as val from {src} where trim({x}) <> ''" for t, (src, *xs) in cols.items() for x in xs)
    return c


def w(body):
    return ctes(**only(base_ctes(), body)) + body


LINK = "(?i)(bitbucket|https?://|git@|\\.git($|[\\s/?#])|repository|repo|репозитор|ссылк|url)"
LCOL = "(?i)(link|url|uri|repo|repstr|branch|commit|git|bitbucket|path|ссыл|репоз)"


def ORACLE():
    uuid = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    x = "raw"
    na = "('$not_applicable$','not applicable','не применимо','неприменимо','n/a','na')"
    flags = {"blank": blank(x), "artifact_missing": art(x), "placeholder": placeholder(x), "filled": filled(x), "required": f"coalesce({required(x)}, false)", "truth": truth(x), "falsehood": falsehood(x),
             "is_na": is_na(x), "has_location": location(x), "link_value": f"coalesce(regexp_matches(raw, '{LINK}'), false)", "valid_category": category(x),
             "uuid_list": f"coalesce(regexp_full_match(trim(raw), '{uuid}(\\s*,\\s*{uuid})*'), false)", "numeric_parseable": "try_cast(trim(raw) as double) is not null", "has_value": has_value(x)}
    latest = lambda src, order, where="true", post="true": (
        f"select model_ver_sid, model_ver_stts_name, cast(start_dt as varchar) start_dt from (select *, row_number() over (partition by model_ver_sid order by {order}) r from {src} where {where}) where r = 1 and {post}")
    inside = f"start_dt <= {D} and end_dt >= {D}"
    st_sql = lambda cur: (
        "select valid_sid, model_ver_sid, valid_stts_name, valid_rslt_name from (select *, dense_rank() over (partition by valid_sid order by start_dt desc, ctl_datechange desc, ctl_loading desc) r from r_valid "
        f"where start_dt <= {D}" + (f" and end_dt >= {D}" if cur else "") + f") where r = 1 and {live()}")
    newest = "(select *, dense_rank() over (partition by model_sid order by model_ver_crtn_dttm desc nulls last) r from {0})"
    def hit_sql(src, n):
        return ("select table_name, column_name, cast(hit_no as integer) hit_no, val as \"value\" from (select *, row_number() over (partition by table_name, column_name order by val) hit_no from (select distinct * from " + src
                + f" where regexp_matches(val, '{LINK}') or (regexp_matches(column_name, '{LCOL}') and lower(trim(val)) not in ('','null','none','nan','-','[]','{{}}','$not_applicable$')))) where hit_no <= {n}")

    from .development import ORACLE as development_oracle
    from .evaluation import w as ev_with
    from .modelling import ORACLE as modelling_oracle

    from .history import ORACLE as history_oracle

    devs, hist = development_oracle(), history_oracle()
    audited_rows = w("select v.* from opened o join k_model_ver v using (model_ver_sid)")
    differ = w("select v.model_ver_sid from k_model_ver v join (select model_ver_sid, max(model_ver_stts_name) st from k_model_ver_anlt_dtl group by 1) a using (model_ver_sid) where st is not null and st is distinct from v.model_ver_stts_name")
    sequence = f"select * from ({hist['log_change_sequence_certain']}) where model_ver_sid in (select model_ver_sid from ({audited_rows}))"
    changes = f"select model_ver_sid, count(*) change_count, count(distinct parameter_sid) changed_parameters, max(change_dttm) last_change from ({sequence}) group by 1"
    summary_rows = " union all ".join(f"select query_id, dim_1_value, dim_2_value from ({devs[f'dev_control_{i:02d}']})" for i in range(1, 32))
    counted = {
        "version_context": audited_rows, "risk_summary": summary_rows, "risk_details": devs["dev_control_detail"], "control_rollup": devs["dev_control_rollup"],
        "version_report": audited_rows, "issue_rollup": devs["dev_issue_rollup"], "model_change_log": sequence, "change_summary": f"select distinct parameter_sid from ({sequence})",
        "red_production": w(f"select valid_sid from certc where {like('valid_rslt_name', 'КРАСН|RED')} and model_ver_sid in (select model_ver_sid from opened where {truth('model_ver_prom_expl_flag')})"),
        "run_diagnostics": "select 1", "invariants": "select 1 where false"}
    from .development import DEV, GATE, STARTED
    from .portfolio import CLOSED, DEPLOY, DUE

    st_name = "model_ver_stts_name"
    is_open, audited = f"not {like(st_name, CLOSED)}", f"not {like(st_name, 'CANCEL|ARCHIV|REJECT')}"
    scopes = {
        "active": is_open, "evidence": f"{like(st_name, 'DEVELOPMENT|' + DUE)} and {is_open}", "deploy": like(st_name, DEPLOY), "validation": f"{like(st_name, DUE)} and {is_open}",
        "development": f"{like(st_name, DEV)} and {audited}", "started": f"{like(st_name, STARTED)} and {audited}", "gate": f"{like(st_name, GATE)} and {audited}"}
    scoped = ("select * from (select 't_valid' table_name, count(*) \"rows\" from k_valid where valid_sid in (select k from c3) or model_ver_sid in (select k from c1) union all select 't_metric', count(*) from k_metric where sample_data_sid in (select k from c6) union all "
              "select 't_model_ver', count(*) from k_model_ver where model_ver_sid in (select k from c1) or model_sid in (select k from c0)) where \"rows\" > 0")

    def q(rule):
        if rule == "linear":
            e = [f"round(quantile_cont(l_extendedprice, {p}), 6) p{int(p * 100)}" for p in (0.1, 0.5, 0.9)]
            return f"select l_returnflag, {', '.join(e)}, count(*) n from lineitem group by 1"
        if rule == "disc":
            e = [f"quantile_disc(l_extendedprice, {p}) p{int(p * 100)}" for p in (0.1, 0.5, 0.9)]
            return f"select l_returnflag, {', '.join(e)}, count(*) n from lineitem group by 1"
        e = [f"min(case when i = cast(floor({p}::double * (n - 1) + 0.5) as bigint) then l_extendedprice end) p{int(p * 100)}" for p in (0.1, 0.5, 0.9)]
        return (f"select l_returnflag, {', '.join(e)}, max(n) n from (select *, row_number() over (partition by l_returnflag order by l_extendedprice) - 1 i, count(*) over (partition by l_returnflag) n from lineitem) group by 1")

    cols = ["model_sid", "model_ver_method_name", "model_ver_data_type_name", "model_ver_dev_report_sid", "model_ver_tgt_txt"]
    tv = {c: f"case when {blank(c)} then '$NULL$' when {placeholder(c)} then '$PLACEHOLDER$' else regexp_replace(trim({c}), '\\s+', ' ', 'g') end" for c in ("model_ver_stts_name", "model_ver_dev_dprtmt_name", "model_ver_repstry_link_txt")}
    parsed = "coalesce(try_cast(date_text as timestamp), try_strptime(date_text, '%d.%m.%Y %H:%M:%S'))"

    def prof(c, date=False, masked=False):
        p = "coalesce(try_cast(c as timestamp), try_strptime(c, '%d.%m.%Y %H:%M:%S'))"
        return (f"(select 'text_probe' source_table, count(*) profiled_row_count, '{c[1]}' column_name, 'string' data_type, count(*) filter (not {blank('c')}) non_missing_count, count(*) filter ({blank('c')}) missing_count, "
                f"count(*) filter (not {blank('c')} and {placeholder('c')}) placeholder_count, round(100.0 * count(*) filter ({blank('c')}) / count(*), 6) missing_pct, count(*) filter (not {blank('c')} and try_cast(trim(c) as double) is not null) numeric_parseable_count, "
                f"round(100.0 * count(*) filter (not {blank('c')} and try_cast(trim(c) as double) is not null) / nullif(count(*) filter (not {blank('c')}), 0), 6) numeric_parseable_pct, "
                + (f"count(*) filter (not {blank('c')} and {real(p)}) valid_date_count, count(*) filter (not {blank('c')} and not {real(p)}) invalid_date_count, " if date else "null::bigint valid_date_count, null::bigint invalid_date_count, ")
                + ("null::varchar min_value, null::varchar max_value" if masked else f"min(case when not {blank('c')} then c end) min_value, max(case when not {blank('c')} then c end) max_value")
                + f" from (select {c[0]} c from r_text_probe))")

    return {
        "text_predicates": w("select raw, count(*) \"rows\", " + ", ".join(f"{e} {n}" for n, e in flags.items()) + f", {norm('raw')} norm, {clean_sql('raw')} clean_dim, coalesce(contains({norm('raw')}, 'host.example'), false) contains_host, "
                             f"case when coalesce({low('raw')} in {na}, false) then 'EXCEPTION' when {has_value('raw')} then 'OK' else 'MISSING' end field_status from r_text_probe group by raw"),
        "date_parse": w(f"select date_text, count(*) \"rows\", {ts(parsed)} parsed, {real(parsed)} real_date from r_text_probe group by date_text"),
        "date_intervals": w(f"select row_sid, {ts(f'case when end_day is null or end_day > {END} or year(end_day) >= 9999 then {END} else end_day end')} capped, coalesce(end_day < start_day, false) inverted, "
                            "round((epoch(end_day) - epoch(start_day)) / 86400.0, 6) \"days\", round((epoch(end_day) - epoch(start_day)) / 3600.0, 6) \"hours\", "
                            "cast(date_diff('day', cast(start_day as date), cast(end_day as date)) as integer) days_late from r_text_probe"),
        "date_age_anchor": w(f"select valid_sid, {ts('case when ' + like('valid_stts_name', 'BACKLOG') + ' then valid_crtn_dttm else coalesce(valid_start_fact_dttm, valid_crtn_dttm) end')} anchor from k_valid"),
        "date_unparsed": w(f"select row_sid, date_text from r_text_probe where not {blank('date_text')} and {parsed} is null"),
        "text_status_scopes": w(" union all ".join(f"(select '{n}' as scope, count(*) versions from k_model_ver where {cond})" for n, cond in scopes.items())),
        "text_mask": "select c_custkey, 'sha256:' || sha256(c_name) masked, substr(sha256('|' || c_name || '|' || c_mktsegment), 1, 16) person, cast(('0x' || substr(md5('s1|' || c_custkey), 1, 8)) as bigint) bucket from customer",
        "text_pseudonymise": "select count(distinct c_name) people, count(*) \"rows\" from customer",
        "text_drop_personal": w("select model_ver_sid, model_ver_stts_name from r_model_ver"),
        "text_map_values": w("select case upper(trim(model_ver_stts_name)) when 'MODEL_VERSION_BACKLOG' then 'Backlog' when 'MODEL_VERSION_DEVELOPMENT' then 'In work' else model_ver_stts_name end label, count(*) versions from k_model_ver group by 1"),
        "state_take_latest": w(latest("r_model_ver", "start_dt desc")), "state_tombstone_after": w(latest("r_model_ver", "start_dt desc", inside, live())),
        "state_tombstone_before": w(latest("r_model_ver", "start_dt desc", inside + " and " + live())),
        "state_prefer_open": w(latest("r_model_ver", f"(end_dt >= {D} + 1 or year(end_dt) >= 9999) desc, ctl_datechange desc, start_dt desc, end_dt desc", "true", live())),
        "state_read": w(st_sql(True)), "state_events": w(st_sql(False)),
        "state_ambiguous": w("select model_sid, count(*) states from (select distinct model_sid, state, ctl_action from (select *, dense_rank() over (partition by model_sid order by y desc) r from (select model_sid, date_trunc('year', start_dt) y, ctl_action, "
                             f"model_ver_stts_name state from r_model_ver where model_sid is not null) where y <= {D}) where r = 1) group by 1 having count(*) > 1"),
        "state_timestamp_grain": w(f"select event_sid, {ts('start_dttm')} start_dttm from r_ent_param_chg where coalesce(start_dttm <= timestamp '2007-12-20 23:59:59', true) and coalesce(end_dttm >= timestamp '2007-12-20 23:59:59', true)"),
        "state_latest_by_priority": w("select model_ver_sid, valid_sid from (select *, row_number() over (partition by model_ver_sid order by coalesce(valid_end_fact_dttm, valid_start_fact_dttm, valid_crtn_dttm) desc nulls last, valid_sid desc) r from k_valid where model_ver_sid is not null) where r = 1"),
        "state_join_latest": w("select m.model_ver_sid, v.valid_sid from k_model_ver m left join (select * from (select *, row_number() over (partition by model_ver_sid order by start_dt desc, valid_sid desc, ctl_loading desc) r from r_valid where model_ver_sid is not null) where r = 1) v using (model_ver_sid)"),
        "state_versions_latest": w("select model_sid, model_ver_sid from " + newest.format("ver") + f" where r = 1 and not {like('model_ver_stts_name', 'CANCEL|ARCHIV|REJECT')}"),
        "state_versions_all": w("select model_sid, model_ver_sid from opened"),
        "state_versions_production": w("select model_sid, model_ver_sid from " + newest.format(f"(select * from opened where {truth('model_ver_prom_expl_flag')})") + " where r = 1"),
        "state_version_problems": w(f"select problem, count(*) \"rows\" from (select case when model_sid is null then 'NO_MODEL' when model_ver_crtn_dttm is null then 'NO_DATE' when model_ver_crtn_dttm > {END} then 'FUTURE_DATE' end problem from ver union all "
                                    "select 'TIED_DATE' from (select model_sid from (select *, dense_rank() over (partition by model_sid order by model_ver_crtn_dttm desc) r from ver where model_sid is not null and model_ver_crtn_dttm is not null) where r = 1 group by 1 having count(*) > 1)) "
                                    "where problem is not null group by 1"),
        "state_certainty": w(f"select * exclude (valid_end_fact_dttm), {ts('valid_end_fact_dttm')} valid_end_fact_dttm from cert"),
        "state_duplicates": "select l_orderkey, l_linenumber, count(*) \"rows\" from lineitem group by 1, 2 having count(*) > 1",
        "state_display": w("select valid_sid, cast(start_dt as varchar) start_dt, ctl_loading, valid_rslt_name from (select *, row_number() over (partition by valid_sid order by start_dt desc, ctl_loading desc, valid_rslt_name nulls last) r from r_valid) where r = 1"),
        "audit_red_in_production": w(f"select valid_sid, model_ver_sid, is_latest from certc where {like('valid_rslt_name', 'КРАСН|RED')} and model_ver_sid in (select model_ver_sid from k_model_ver_anlt_dtl where {truth('model_ver_prom_expl_flag')})"),
        "audit_attempts": w("select * from attempts"),
        "audit_version_report": f"select v.model_ver_sid, v.model_sid, v.model_ver_stts_name, coalesce(failed_controls, 0) failed_controls, coalesce(failed_high_controls, 0) failed_high_controls, coalesce(change_count, 0) change_count, "
                                f"coalesce(changed_parameters, 0) changed_parameters, last_change from ({audited_rows}) v left join ({devs['dev_version_rollup']}) d using (model_ver_sid) left join ({changes}) c using (model_ver_sid)",
        "audit_run_diagnostics": f"select count(*) versions, count(distinct model_sid) models, count(*) filter (model_ver_sid in ({differ})) status_disagreement from ({audited_rows})",
        "audit_frame_rows": " union all ".join(f"select '{n}' frame, count(*) \"rows\" from ({q_})" for n, q_ in counted.items()),
        "audit_status_disagreement": w("select count(*) versions from k_model_ver v join k_model_ver_anlt_dtl a using (model_ver_sid) where a.model_ver_stts_name is not null and a.model_ver_stts_name is distinct from v.model_ver_stts_name"),
        "join_closure": w(" union all ".join(f"select '{k}' kind, k as \"key\" from c{i}" for i, k in enumerate(("model", "version", "prom", "valid", "auto", "auto_result", "sample")))),
        "join_flags": w(f"select v.model_ver_sid, any_alt, coalesce(located, 0) located from (select model_ver_sid, cast(max(cast({truth('valid_alt_flag')} as integer)) as integer) any_alt from k_valid where model_ver_sid is not null group by 1) v left join "
                        f"(select distinct model_ver_sid, 1 located from k_sample_data where model_ver_sid is not null and {location('sample_data_addtnl_info_txt')}) using (model_ver_sid)"),
        "join_resolve_parent": w("select s.sample_data_sid, coalesce(s.model_ver_sid, v.model_ver_sid) as version from k_sample_data s left join k_valid v using (valid_sid)"),
        "join_key_overlap": w("select count(*) shared_keys from (select model_ver_sid, valid_sid from r_valid where model_ver_sid is not null and valid_sid is not null intersect select model_ver_sid, valid_sid from r_sample_data)"),
        "join_first_by": "select l_orderkey, l_linenumber, b.p l_partkey, b.s l_suppkey from (select l_orderkey, l_linenumber, min({'p': l_partkey, 's': l_suppkey}) b from lineitem group by 1, 2)",
        "join_residual": w("select m.model_ver_sid, l.event_sid from k_model_ver m join r_ent_param_chg l on l.ent_sid = m.model_ver_sid and (starts_with(upper(ent_param_chg_sid), 'MODEL_VERSION_') or upper(ent_type_name) in ('MODEL_VERSION','MODEL_VER'))"),
        "join_set_flow": w("select case when model_ver_sid in (select model_ver_sid from k_model_ver) then 1 end known, count(*) \"rows\" from k_valid group by 1"),
        "measure_missingness": w(" union all ".join(f"(select '{c}' column_name, count(*) filter ({c} is null) null_count, count(*) filter ({blank(c)}) blank_count, round(100.0 * count(*) filter ({blank(c)}) / count(*), 2) blank_pct from k_model_ver)" for c in cols)),
        "measure_quantile_disc": q("disc"), "measure_quantile_nearest": q("nearest"), "measure_quantile_linear": q("linear"),
        "window_row_number": "select o_orderstatus, o_orderkey, row_number() over (partition by o_orderstatus order by o_totalprice, o_orderkey) rank from orders",
        "window_top_n": "select o_orderstatus, o_orderkey, o_totalprice, cast(rank as integer) rank from (select *, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) rank from orders) where rank <= 5",
        "window_seeded_limit": "select o_orderkey from orders order by md5('lim|' || o_orderkey), o_orderkey limit 25",
        "profile_summary": "select 'lineitem' source_table, 'l_orderkey|l_linenumber' key_columns, count(*) source_row_count, count(distinct (l_orderkey, l_linenumber)) distinct_keys, count(*) - count(distinct (l_orderkey, l_linenumber)) possible_duplicates from lineitem",
        "profile_columns": w(" union all ".join([prof(("raw", "raw")), prof(("date_text", "seen_date"), date=True), prof(("row_sid", "note_txt"), masked=True)])),
        "profile_top_values": w(" union all ".join(
            f"(select 'model_ver' source_table, '{c}' column_name, cast(r as integer) sample_rank, v sample_value, n value_count, round(100.0 * n / t, 6) value_pct from (select *, row_number() over (order by n desc, v) r, sum(n) over () t from "
            f"(select {e} v, count(*) n from r_model_ver group by 1)) where r <= 4)" for c, e in tv.items())),
        "profile_masked_rows": w("select 'busn_task' source_table, row_json from (select distinct '{\"busn_task_name\":\"' || busn_task_name || '\"' || case when busn_task_claim_descr_txt is null then '' else ',\"busn_task_claim_descr_txt\":\"sha256:' || "
                                 "sha256(trim(busn_task_claim_descr_txt)) || '\"' end || '}' row_json from r_busn_task) order by md5(row_json), row_json limit 10"),
        "probe_first_values": w("select table_name, column_name, cast(n as integer) value_no, val as \"value\" from (select *, row_number() over (partition by table_name, column_name order by val) n from (select distinct * from lng)) where n <= 10"),
        "probe_link_hits": w(hit_sql("lng", 15)),
        "probe_page_links": hit_sql("(select 'pages' table_name, 'page_id' column_name, cast(page_id as varchar) val from pages union all select 'pages', 'url', url from pages where trim(url) <> '')", 20),
        "probe_scoped_rows": w(scoped),
        "probe_coverage": w("select t.table_name, case when relation_keys = '' then 'NO_RELATION_KEY' when \"rows\" > 0 then 'OK' else 'NO_MATCH' end status, relation_keys, null::varchar error from (values ('t_genai', ''), ('t_metric', 'sample_data_sid'), "
                            "('t_model_ver', 'model_sid, model_ver_sid'), ('t_valid', 'model_ver_sid, valid_sid')) t(table_name, relation_keys) left join (" + scoped + ") x on x.table_name = t.table_name"),
        "probe_link_rows": "select 'pages' table_name, to_json({'page_id': page_id, 'url': url})::varchar row_json from pages where coalesce(regexp_matches(cast(page_id as varchar), '" + LINK + "'), false) or coalesce(regexp_matches(url, '" + LINK
                           + "'), false) or lower(trim(url)) not in ('','null','none','nan','-','[]','{}','$not_applicable$')",
        "profile_summary_approx": "select 'lineitem' source_table, 'l_orderkey|l_linenumber' key_columns, count(*) source_row_count, true holds from lineitem",
        "measure_approx_quantile": "select l_returnflag, count(*) denominator, true holds from lineitem group by 1",
        "source_json_lines": ev_with("select fidelity, count(*) trials, cast(sum(n_features) as bigint) features from t group by 1"),
        "source_partitioned_roles": f"select role, count(*) \"rows\" from ({modelling_oracle()['split_group']}) group by 1",
        "audit_summary_sheet": f"select v.model_ver_sid, v.model_sid, {', '.join(f'coalesce(check_{i:02d}, 0) check_{i:02d}' for i in range(1, 29))}, a.* exclude (model_ver_sid) "
                               f"from ({w('select * from ver')}) v left join ({development_oracle()['dev_violation_matrix']}) m using (model_ver_sid) left join ({w('select * from attempts')}) a using (model_ver_sid) where {truth('v.model_ver_prom_expl_flag')}",
        "source_csv": "select o_orderkey, o_orderstatus from orders",
        "source_saved_detail": w("select 1 query_id, count(*) \"rows\" from k_valid"),
        "source_inventory": "select cast(1 as bigint) files, count(*) \"rows\", cast(11 as integer) columns from lineitem",
        "source_glob": "select o_orderkey from orders", "source_select_existing": "select o_orderkey, o_orderstatus from orders",
        "source_export": "select l_orderkey trial_id, '[' || array_to_string(list_transform(list_sort(list(distinct 'f' || cast(l_partkey % 12 as varchar))), lambda x: '\"' || x || '\"'), ',') || ']' features from lineitem where l_orderkey in (select o_orderkey from orders) group by 1",
    }
