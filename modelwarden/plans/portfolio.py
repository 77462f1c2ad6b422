"""50 portfolio queries over models, validations, monitoring, implementation and GenAI versions.

A query is a base frame plus either two dimensions to count by, a set of indicators with their
own scopes, or a duration. Summary and detail rows come from the same description.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_anchor, as_of_day, duration_days, real_date
from ..functions.predicates import (
    ALL_DIM, NULL_DIM, artifact_missing, blank, clean_dim, dim, falsehood, status_like, truth,
)
from ..operators import measures as m
from ..operators.relate import without_children
from ..operators.state import latest_by_priority

# --- fixed values: status patterns and limits --------------------------------
CLOSED = "DONE|COMPLETE|COMPLETED|CLOSED|CANCEL|CANCELED|REJECT|ARCHIV|ЗАВЕРШ|ЗАКРЫТ|ОТМЕН|ОТКЛОН"
RED = "RED|КРАСН"
OUT_OF_TIME = r"OUT[-_ ]?OF[-_ ]?TIME|\bOOT\b|ВНЕВРЕМ"
VALID_ACTIVE = "BACKLOG|DATA_PREPARATION|PROCESS|AWAITING_RESULTS|APPROVAL|RESULTS_APPROVE"
VALID_EXCLUDED = "NOT_NEEDED|SUSPENDED|CANCEL|CLOSED|DONE|COMPLETE|REJECT|ARCHIV"
VALID_FINAL = "DONE|COMPLETE|RESULTS_APPROVE|ЗАВЕРШ"
VALID_DROPPED = "CANCEL|REJECT|NOT_NEEDED"
DEPLOY = "DECISION_MAKING|OWNER_APPROVE|PILOTING_PERMITTED|PREPARATION_EXPLOIT|EXPLOIT_PERMITTED"
VALIDATION_DUE = "VERIFICATION|AWAITING_VALIDATION|TRAIN_VALIDATION|" + DEPLOY
EVIDENCE_DUE = "DEVELOPMENT|" + VALIDATION_DUE
NO_TARGET = "CLUSTER|КЛАСТЕР|UNSUPERVISED|БЕЗ УЧИТЕЛЯ|EMBEDDING|ЭМБЕДДИНГ"
PROM_ACTIVE = "AWAITING_ARTIFACTS|AWAITING_VALIDATION|DEVELOPMENT|READY_FOR_UAT|PILOTING_PERMITTED|EXPLOIT_PERMITTED"
PROM_VALIDATED = "READY_FOR_UAT|PILOTING_PERMITTED|EXPLOIT_PERMITTED"
GENAI_EARLY = "BACKLOG|NEW|DRAFT|CANCEL|ARCHIV|REJECT"
GENAI_RUNNING = "PILOT|EXPLOIT|PROD|RELEASE|PERMITTED"
FINISHED = "DONE|COMPLETE|ЗАВЕРШ"
CRITICAL = ("A", "B")
OPEN_SLA_DAYS = 90
STALE_MONITORING_DAYS = 365
# ------------------------------------------------------------------------------

#: What the queries over the newest validation of a version read from it.
LATEST_COLUMNS = (
    "valid_rslt_name", "valid_dprtmt_name", "valid_red_zone_owner_aprvl_rsk_flag", "valid_red_zone_comt_rsk_decsn_sid",
    "valid_red_zone_comt_rsk_decsn_link_txt", "valid_alt_flag", "valid_alt_metric_name", "valid_alt_metric_val",
)
#: Contract: the columns of a version that the queries read, so that keeping the table does not carry the rest.
VERSION_COLUMNS = (
    "model_ver_sid", "model_sid", "model_ver_stts_name", "model_ver_signfcnt_ctgry_code", "model_ver_owner_dprtmt_name", "model_ver_dev_dprtmt_name",
    "model_ver_method_name", "model_ver_data_type_name", "model_ver_tgt_txt", "model_ver_llm_flag", "model_ver_repstry_link_txt", "model_ver_repstry_commit_sid",
    "model_ver_dev_src_name", "model_ver_dev_report_sid", "model_ver_dev_start_fact_dttm", "model_ver_dev_end_plan_dttm", "model_ver_dev_end_fact_dttm",
    "model_ver_proj_feature_flag", "model_ver_proj_feature_sid", "model_ver_montrg_auto_flag",
)


class Context:
    """As-of tables by short name, and the scopes cut from them.

    ``hold`` keeps the tables and the newest validations when many queries read them; pass a function that writes them.
    ``kept`` says that the tables come kept already.
    """

    def __init__(self, table: Callable[[str], DataFrame], as_of: str, hold: Callable[[DataFrame], DataFrame] = lambda df: df, kept: bool = False):
        self._table, self.as_of, self._hold, self._kept, self._seen = table, as_of, hold, kept, {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._seen:
            scope = getattr(self, f"_{name}", None)
            self._seen[name] = scope() if scope else self._table(name) if self._kept else self._hold(self._table(name))
        return self._seen[name]

    def _versions(self):
        return self("model_ver").filter(~status_like("model_ver_stts_name", CLOSED))

    def _evidence(self):
        return self("versions").filter(status_like("model_ver_stts_name", EVIDENCE_DUE))

    def _deploy(self):
        return self("versions").filter(status_like("model_ver_stts_name", DEPLOY))

    def _due(self):
        return self("versions").filter(status_like("model_ver_stts_name", VALIDATION_DUE))

    def _completed(self):
        final = status_like("valid_stts_name", VALID_FINAL) | real_date("valid_end_fact_dttm")
        return self("valid").filter(~blank("valid_rslt_name") & ~status_like("valid_stts_name", VALID_DROPPED) & final)

    def _latest(self):
        moments = ["valid_end_fact_dttm", "valid_start_fact_dttm", "valid_crtn_dttm"]
        rows = self("completed").filter("model_ver_sid is not null").select("model_ver_sid", "valid_sid", *moments, *LATEST_COLUMNS)
        return self._hold(latest_by_priority(rows, "model_ver_sid", moments, "valid_sid"))

    def _open_valid(self):
        s = "valid_stts_name"
        return self("valid").filter(status_like(s, VALID_ACTIVE) & ~status_like(s, VALID_EXCLUDED))

    def _prom(self):
        return self("model_ver_prom").filter(status_like("model_ver_prom_stts_name", PROM_ACTIVE))

    def _gv(self):
        return self("genai_ver").filter(~status_like("genai_ver_stts_name", GENAI_EARLY))

    def with_model(self, name: str, how: str = "left") -> DataFrame:
        return self(name).join(self("model").drop("start_dt", "end_dt", "ctl_action", "ctl_datechange"), "model_sid", how)

    def with_genai(self, name: str) -> DataFrame:
        return self(name).join(self("genai").drop("start_dt", "end_dt", "ctl_action", "ctl_datechange"), "genai_sid", "left")

    def latest_in(self, scope: str) -> DataFrame:
        keep = self(scope).select("model_ver_sid", "model_ver_signfcnt_ctgry_code")
        return self("latest").join(keep, "model_ver_sid")

    def results_with_sample(self, kind: str) -> DataFrame:
        sid = f"montrg_{kind}_rslt_sid"
        done = self(f"montrg_{kind}_rslt").filter(status_like(f"montrg_{kind}_rslt_stts_name", FINISHED))
        return without_children(done, self("sample_data").select(sid), sid)


@dataclass(frozen=True)
class Query:
    id: int
    name: str
    domain: str
    entity: str
    kind: str                      # dist | gap | multi | days | rows
    base: Callable[[Context], DataFrame]
    d1: Column | None = None
    d2: Column | None = None
    indicators: tuple = ()         # (name, applies, bad)
    dims: tuple[str, str] = ("", "")
    source: tuple[str, str] = ("MODEL_VER", "model_ver_sid")
    days: Column | None = None
    metric: str = "risk_rate_pct"
    extra: Callable | None = field(default=None, repr=False)


def _stale(date: str, as_of: str) -> Column:
    return ~real_date(date) | (F.datediff(as_of_day(as_of), F.col(date).cast("date")) > STALE_MONITORING_DAYS)


def _overdue(date: str, as_of: str) -> Column:
    return real_date(date) & (F.col(date).cast("date") < as_of_day(as_of))


def queries(as_of: str) -> dict[int, Query]:
    yes = F.lit(True)
    P, V, G = "model_ver_", "valid_", "genai_ver_"
    sig, gsig = dim(P + "signfcnt_ctgry_code"), dim(G + "signfcnt_ctgry_code")
    status = dim(P + "stts_name")
    out: dict[int, Query] = {}

    def add(*args, **kw):
        q = Query(*args, **kw)
        out[q.id] = q

    def dist(i, name, domain, base, d1, d2, dims, entity="MODEL", metric="version_count"):
        add(i, name, domain, entity, "dist", base, d1, d2, dims=dims, metric=metric)

    def gap(i, name, domain, base, bad, d1, d2, dims, issue, source=("MODEL_VER", "model_ver_sid"), entity="MODEL"):
        add(i, name, domain, entity, "gap", base, d1, d2, ((issue, yes, bad),), dims, source)

    def multi(i, name, domain, base, d2, dims, indicators, source=("MODEL_VER", "model_ver_sid"), entity="MODEL", **kw):
        add(i, name, domain, entity, "multi", base, None, d2, tuple(indicators), dims, source, **kw)

    VALID, AUTO, MANUAL = ("VALID", "valid_sid"), ("MONTRG_AUTO", "montrg_auto_sid"), ("MONTRG_MANUAL", "montrg_manual_sid")
    GV, GW = ("GENAI_VER", "genai_ver_sid"), ("GENAI_VER_VALID", "genai_ver_valid_sid")
    needs_target = ~truth(P + "llm_flag") & ~status_like("model_type_name", NO_TARGET)
    target = ("target", needs_target, blank(P + "tgt_txt"))
    repo, commit = P + "repstry_link_txt", P + "repstry_commit_sid"

    # portfolio, documentation, data, development
    dist(1, "Versions by significance and status", "portfolio", lambda c: c("versions"), sig, status, ("significance", "status"))
    dist(2, "Versions by model type and task", "portfolio", lambda c: c.with_model("versions", "inner"),
         dim("model_type_name"), dim("model_ml_task_name"), ("model_type", "ml_task"))
    dist(3, "Risk models by type and segment", "portfolio",
         lambda c: c.with_model("versions", "inner").filter(truth("model_rsk_flag")),
         dim("model_rsk_type_name"), dim("model_rsk_sgmnt_name"), ("risk_type", "risk_segment"))
    dist(4, "Critical versions by owner", "portfolio",
         lambda c: c("versions").filter(F.col(P + "signfcnt_ctgry_code").isin(*CRITICAL)),
         dim(P + "owner_dprtmt_name"), sig, ("owner_department", "significance"))
    multi(5, "Key metadata gaps", "documentation", lambda c: c.with_model("versions"), sig, ("missing_field", "significance"), [
        ("owner_department", yes, blank(P + "owner_dprtmt_name")), ("method", yes, blank(P + "method_name")),
        ("significance", yes, blank(P + "signfcnt_ctgry_code")), target])
    gap(6, "Repository link missing", "reproducibility", lambda c: c("evidence"), artifact_missing(repo), sig,
        dim(P + "dev_src_name"), ("significance", "dev_source"), "repository_missing")
    gap(7, "Commit missing although a repository is given", "reproducibility", lambda c: c("evidence").filter(~artifact_missing(repo)),
        artifact_missing(commit), sig, dim(P + "dev_src_name"), ("significance", "dev_source"), "commit_missing")
    gap(8, "Development report missing", "documentation", lambda c: c("evidence"), artifact_missing(P + "dev_report_sid"), sig, status,
        ("significance", "status"), "development_report_missing")
    multi(9, "Target or data type missing", "data_governance", lambda c: c.with_model("evidence"), sig, ("missing_field", "significance"),
          [("data_type", yes, blank(P + "data_type_name")), target])
    gap(10, "Versions without samples", "data_governance",
        lambda c: without_children(c("evidence"), c("sample_data").select("model_ver_sid"), "model_ver_sid"),
        F.col("has_child") == 0, sig, status, ("significance", "status"), "sample_missing")
    gap(11, "Versions without an out-of-time sample", "data_governance",
        lambda c: without_children(
            c("evidence"), c("sample_data").filter(status_like("sample_data_prop_array", OUT_OF_TIME)).select("model_ver_sid"), "model_ver_sid"),
        F.col("has_child") == 0, sig, status, ("significance", "status"), "oot_sample_missing")

    def samples_with_metric(c: Context) -> DataFrame:
        have = m.any_by(c("metric"), "sample_data_sid", F.col("metric_sid").isNotNull() & ~blank("metric_val"), "has_metric")
        return c("sample_data").join(have, "sample_data_sid", "left").fillna({"has_metric": 0})

    no_calc = truth("sample_data_not_metric_calc_flag")
    add(12, "Samples without usable metrics", "data_governance", "MODEL", "multi", samples_with_metric, None, None, (
        ("metric_calc_disabled", yes, no_calc), ("metric_missing_unexplained", yes, ~no_calc & (F.col("has_metric") == 0))),
        ("sample_type", "gap_type"), ("SAMPLE_DATA", "sample_data_sid"), extra="swap", days=dim("sample_data_type_name"))
    pe, fe, fs = P + "dev_end_plan_dttm", P + "dev_end_fact_dttm", P + "dev_start_fact_dttm"
    multi(13, "Development overdue or late", "development", lambda c: c("evidence"), clean_dim(P + "dev_dprtmt_name"),
          ("overdue_type", "department"), [
              ("open_overdue", yes, _overdue(pe, as_of) & ~real_date(fe)),
              ("completed_late", yes, real_date(pe) & real_date(fe) & (F.col(fe) > F.col(pe)))])
    add(14, "Development duration", "development", "MODEL", "days", lambda c: c("model_ver").filter(real_date(fs) & real_date(fe)),
        clean_dim(P + "dev_dprtmt_name"), dims=("department", "statistic"), days=duration_days(fe, fs), metric="duration_days")
    ff, fp = truth(P + "proj_feature_flag"), blank(P + "proj_feature_sid")
    multi(15, "Feature-store flag and project disagree", "data_governance", lambda c: c("versions"), sig, ("indicator", "significance"),
          [("flag_true_project_missing", yes, ff & fp), ("project_present_flag_not_true", yes, ~fp & ~ff)])

    # validation
    vdep, vstat, vres, vtype = (V + x for x in ("dprtmt_name", "stts_name", "rslt_name", "type_name"))
    gap(16, "Validation coverage", "validation",
        lambda c: without_children(c("due"), c("completed").select("model_ver_sid"), "model_ver_sid"),
        F.col("has_child") == 0, sig, status, ("significance", "status"), "completed_validation_missing")
    dist(17, "Latest validation results", "validation", lambda c: c.latest_in("versions"), dim(vres), sig, ("result", "significance"),
         metric="validation_count")
    anchor = age_anchor(vstat, V + "crtn_dttm", V + "start_fact_dttm")
    gap(18, "Open validation older than the limit", "validation", lambda c: c("open_valid"),
        real_date(anchor) & (F.datediff(as_of_day(as_of), anchor.cast("date")) > OPEN_SLA_DAYS),
        clean_dim(vdep), clean_dim(vstat), ("department", "status"), "validation_open_too_long", VALID)
    gap(19, "Periodic validation overdue", "validation", lambda c: c("open_valid"), _overdue(V + "freq_start_plan_dttm", as_of),
        clean_dim(vdep), clean_dim(vstat), ("department", "status"), "periodic_validation_overdue", VALID)
    vs, ve = V + "start_fact_dttm", V + "end_fact_dttm"
    add(20, "Validation duration", "validation", "MODEL", "days", lambda c: c("completed").filter(real_date(vs) & real_date(ve)),
        clean_dim(vdep), dims=("department", "statistic"), days=duration_days(ve, vs), metric="duration_days")
    reason = V + "dev_return_reason_txt"
    dist(21, "Returns to the developer", "validation", lambda c: c("valid").filter(F.trim(reason) != ""), F.col(reason), dim(vdep),
         ("return_reason", "department"), metric="return_count")
    for i, name, col, issue in ((22, "Validations without a sample", "not_sample_data_flag", "validation_without_sample"),
                                (23, "Non-tabular validation source", "src_not_table_flag", "non_tabular_source")):
        gap(i, name, "validation", lambda c: c("completed"), truth(V + col), dim(vres), dim(vtype), ("result", "type"), issue, VALID)
    gap(24, "Validations without a report", "validation", lambda c: c("completed"), artifact_missing(V + "report_sid"), clean_dim(vres),
        clean_dim(vdep), ("result", "department"), "validation_report_missing", VALID)
    red = lambda c: c.latest_in("deploy").filter(status_like(vres, RED))
    gap(25, "Red result without the owner's acceptance", "validation", red, ~truth(V + "red_zone_owner_aprvl_rsk_flag"),
        clean_dim(vdep), clean_dim(vres), ("department", "result"), "owner_acceptance_missing", VALID)
    gap(26, "Red result without a committee decision", "validation", red,
        artifact_missing(V + "red_zone_comt_rsk_decsn_sid") | artifact_missing(V + "red_zone_comt_rsk_decsn_link_txt"),
        clean_dim(vdep), clean_dim(vres), ("department", "result"), "committee_decision_missing", VALID)
    dist(27, "Validation problems", "validation", lambda c: c("completed").filter(F.col(V + "prblm_name").isNotNull()),
         F.col(V + "prblm_name"), dim(vres), ("problem", "result"), metric="problem_count")
    alt = V + "alt_flag"
    multi(28, "Alternative modelling", "validation", lambda c: c.latest_in("versions"), sig, ("indicator", "significance"), [
        ("alt_flag_missing", yes, blank(alt)), ("alt_not_run", ~blank(alt), falsehood(alt)),
        ("alt_metric_missing", truth(alt), blank(V + "alt_metric_name") | blank(V + "alt_metric_val"))], VALID)
    gap(29, "Validation-agent flag blank", "agent_validation", lambda c: c("completed"), blank(V + "agent_usg_flag"), dim(vtype), dim(vres),
        ("type", "result"), "agent_flag_missing", VALID)
    agent = truth(V + "agent_usg_flag")
    multi(30, "Agent-validation data gaps", "agent_validation", lambda c: c("completed"), dim(vtype), ("missing_field", "validation_type"), [
        ("quality_correct_pct", agent, F.col(V + "agent_test_quality_corr_pct").isNull()),
        ("quality_reuse_pct", agent, F.col(V + "agent_test_quality_reuse_pct").isNull()),
        ("quantity_reuse_pct", agent, F.col(V + "agent_test_quantity_reuse_pct").isNull()),
        ("non_usage_reason", falsehood(V + "agent_usg_flag"), blank(V + "agent_non_usg_reason_name"))], VALID)
    dist(31, "Validation type and status", "agent_validation", lambda c: c("completed"), dim(vtype), dim(vstat),
         ("validation_type", "status"), metric="validation_count")
    dist(32, "Reuse of prevalidation", "validation", lambda c: c("completed"), dim(V + "prevalid_reuse_lvl_name"),
         dim(V + "prevalid_reuse_lvl_reason_array"), ("reuse_level", "reason"), metric="validation_count")

    # monitoring, implementation, integrity
    mon = P + "montrg_auto_flag"
    linked = F.col("has_child") == 1
    multi(33, "Monitoring flag and link disagree", "monitoring",
          lambda c: without_children(c("evidence"), c("model_ver_x_montrg_auto").select("model_ver_sid"), "model_ver_sid"), sig,
          ("indicator", "significance"), [
              ("monitoring_flag_missing", yes, blank(mon)), ("monitoring_link_missing", truth(mon), ~linked),
              ("link_present_flag_not_true", ~truth(mon), linked)])
    A = "montrg_auto_"
    gap(34, "Automatic monitoring overdue", "monitoring", lambda c: c("montrg_auto").filter(~status_like(A + "stts_name", CLOSED)),
        _overdue(A + "next_dttm", as_of), dim(A + "dprtmt_name"), dim(A + "stts_name"), ("department", "status"), "next_run_overdue", AUTO)
    sched = A + "proj_sched_stts_name"
    on = F.upper(dim(sched)) == "ACTIVE"
    multi(35, "Schedule gaps", "monitoring", lambda c: c("montrg_auto"), dim(sched), ("schedule_gap", "schedule_status"), [
        ("schedule_status_missing", yes, blank(sched)), ("cron_missing", on, blank(A + "proj_sched_cron_txt")),
        ("schedule_start_missing", on, ~real_date(A + "proj_sched_start_dttm")), ("next_run_missing", on, ~real_date(A + "next_dttm"))], AUTO)
    for i, kind, source in ((36, "auto", "MONTRG_AUTO_RSLT"), (38, "manual", "MONTRG_MANUAL_RSLT")):
        R = f"montrg_{kind}_rslt_"
        off, none = truth(R + "not_metric_main_flag"), truth(R + "valid_not_sample_data_flag")
        multi(i, f"Result gaps, {kind} monitoring", "monitoring", lambda c, kind=kind: c.results_with_sample(kind), dim(R + "name"),
              ("indicator_or_result" if kind == "auto" else "indicator", "result"), [
                  ("metric_not_calculated", yes, off), ("metric_missing_unexplained", yes, F.col(R + "metric_val").isNull() & ~off),
                  ("sample_explicitly_absent", yes, none), ("sample_link_missing_unexplained", yes, ~linked & ~none),
                  ("report_missing", yes, artifact_missing(R + "report_sid"))], (source, R + "sid"), metric="result_count_or_gap_pct")
    M = "montrg_manual_"
    multi(37, "Manual monitoring freshness", "monitoring", lambda c: c("montrg_manual").filter(~status_like(M + "stts_name", CLOSED)),
          dim(M + "stts_name"), ("indicator", "status"), [
              ("last_result_missing", yes, blank(M + "last_rslt_name")),
              ("last_result_missing_or_stale", yes, _stale(M + "last_rslt_dttm", as_of)),
              ("next_run_overdue", yes, _overdue(M + "next_dttm", as_of))], MANUAL)

    def problems(c: Context) -> DataFrame:
        parts = [
            c(f"montrg_{kind}_rslt").filter(~blank(f"montrg_{kind}_rslt_prblm_name") & status_like(f"montrg_{kind}_rslt_stts_name", FINISHED))
            .select(F.lit(channel).alias("channel"), F.col(f"montrg_{kind}_rslt_prblm_name").alias("problem"))
            for kind, channel in (("auto", "automatic"), ("manual", "manual"))
        ]
        return parts[0].unionByName(parts[1])

    dist(39, "Monitoring problems by channel", "monitoring", problems, F.col("channel"), F.col("problem"), ("channel", "problem"),
         metric="problem_count")

    def prom_with_it(c: Context) -> DataFrame:
        latest = latest_by_priority(c("valid_it"), "model_ver_prom_sid", ["valid_it_end_dttm", "valid_it_start_dttm", "valid_it_crtn_dttm"], "valid_it_sid")
        return c("prom").join(latest.select("model_ver_prom_sid", "valid_it_sid", "valid_it_stts_name"), "model_ver_prom_sid", "left")

    post = status_like("model_ver_prom_stts_name", PROM_VALIDATED)
    multi(40, "IT validation and gate flags", "implementation", prom_with_it, dim("model_ver_prom_stts_name"), ("indicator", "prom_status"), [
        ("it_validation_missing_or_incomplete", post, F.col("valid_it_sid").isNull() | ~status_like("valid_it_stts_name", FINISHED)),
        ("qgm_flag_missing", post, blank("model_ver_prom_valid_it_rslt_qgm_flag")),
        ("implementation_flag_missing", post, blank("model_ver_prom_implm_flag"))], ("MODEL_VER_PROM", "model_ver_prom_sid"))

    def implementations(c: Context) -> DataFrame:
        parts = [
            c(f"{kind}_implm").select(
                F.lit(label).alias("kind"), F.col(f"{kind}_implm_stts_name").alias("status"), F.col(f"{kind}_implm_sid").alias("implm_sid"),
                F.col(f"{kind}_implm_start_plan_dttm").alias("plan_dt"), F.col(f"{kind}_implm_start_fact_dttm").alias("fact_dt"))
            for kind, label in (("pilot", "pilot"), ("prom", "industrial"))
        ]
        return parts[0].unionByName(parts[1])

    late = real_date("plan_dt") & (
        (~real_date("fact_dt") & (F.col("plan_dt").cast("date") < as_of_day(as_of))) | (real_date("fact_dt") & (F.col("fact_dt") > F.col("plan_dt"))))
    gap(41, "Pilot or industrial rollout late", "implementation", implementations, late, F.col("kind"), dim("status"),
        ("implementation_type", "status"), "rollout_late", ("IMPLEMENTATION", "implm_sid"))

    relations = (
        ("MODEL_VER->MODEL", "model_ver", "model", "model_sid", False), ("VALID->MODEL_VER", "valid", "model_ver", "model_ver_sid", False),
        ("SAMPLE->MODEL_VER", "sample_data", "model_ver", "model_ver_sid", True), ("METRIC->SAMPLE", "metric", "sample_data", "sample_data_sid", True),
        ("X_AUTO->AUTO", "model_ver_x_montrg_auto", "montrg_auto", "montrg_auto_sid", False),
        ("X_MANUAL->MANUAL", "model_ver_x_montrg_manual", "montrg_manual", "montrg_manual_sid", False),
        ("GENAI_VER->GENAI", "genai_ver", "genai", "genai_sid", False),
        ("GENAI_SAMPLE->GENAI_VER", "genai_ver_sample_data", "genai_ver", "genai_ver_sid", False),
        ("GENAI_VALID->GENAI_VER", "genai_ver_valid", "genai_ver", "genai_ver_sid", False),
        ("VALID_IT->MODEL_VER_PROM", "valid_it", "model_ver_prom", "model_ver_prom_sid", False),
    )
    add(42, "Orphan rates", "data_quality", "ALL", "rows", lambda c: reduce(
        lambda a, b: a.unionByName(b),
        [m.orphan_rate(c(child), c(parent), key, key, rel, skip) for rel, child, parent, key, skip in relations]),
        dims=("relation", ""), metric="orphan_rate_pct")

    # GenAI
    def attributes(c: Context) -> DataFrame:
        pairs = [("version_status", dim(G + "stts_name")), ("significance", gsig), ("agent_flag", dim("genai_agent_flag")),
                 ("priority", dim(F.upper(F.trim("genai_priority_lvl_code")))), ("maturity", dim("genai_maturity_lvl_ord"))]
        return c.with_genai("genai_ver").select(
            F.inline(F.array(*[F.struct(F.lit(n).alias("attribute"), v.alias("value")) for n, v in pairs])))

    dist(43, "GenAI portfolio attributes", "genai_portfolio", attributes, F.col("attribute"), F.col("value"), ("portfolio_attribute", "value"), "GENAI")
    grepo = G + "repstry_link_txt"
    running = status_like(G + "stts_name", GENAI_RUNNING)
    multi(44, "GenAI documentation gaps", "genai_governance", lambda c: c.with_genai("gv"), gsig, ("missing_field", "significance"), [
        ("owner", yes, blank("genai_owner_dprtmt_name")), ("repository", yes, artifact_missing(grepo)),
        ("commit", ~artifact_missing(grepo), artifact_missing(G + "repstry_commit_link_txt") & artifact_missing(G + "distr_commit_link_txt")),
        ("development_report", yes, artifact_missing(G + "dev_report_sid")), ("release", running, artifact_missing(G + "release_link_txt"))],
        GV, "GENAI")
    multi(45, "GenAI data gaps", "genai_data",
          lambda c: without_children(c("gv"), c("genai_ver_sample_data").select("genai_ver_sid"), "genai_ver_sid"), gsig,
          ("indicator", "significance"), [("sample_missing", yes, ~linked),
                                          ("data_knowledge_level_missing", yes, blank(G + "sample_data_knowledge_lvl_name"))], GV, "GENAI")
    W = "genai_ver_valid_"

    def genai_latest(c: Context) -> DataFrame:
        latest = latest_by_priority(c("genai_ver_valid"), "genai_ver_sid", [W + "end_fact_dttm", W + "start_fact_dttm", W + "crtn_dttm"], W + "sid")
        return c("gv").join(latest.select("genai_ver_sid", W + "rslt_name"), "genai_ver_sid", "left")

    dist(46, "GenAI validation coverage and result", "genai_validation", genai_latest, F.coalesce(W + "rslt_name", F.lit("NO_VALIDATION")), gsig,
         ("validation_result", "significance"), "GENAI")
    wres = dim(W + "rslt_name")
    gdays = F.when(real_date(W + "start_fact_dttm") & real_date(W + "end_fact_dttm"),
                   F.datediff(F.col(W + "end_fact_dttm").cast("date"), F.col(W + "start_fact_dttm").cast("date")))
    multi(47, "GenAI validation gaps and duration", "genai_validation", lambda c: c("genai_ver_valid").filter(~blank(W + "rslt_name")), wres,
          ("indicator", "result"), [
              ("report_missing", yes, artifact_missing(W + "report_sid")),
              ("alt_metric_missing", yes, truth(W + "alt_flag") & (blank(W + "alt_metric_name") | blank(W + "alt_metric_val")))],
          GW, "GENAI", metric="risk_rate_pct_or_days", days=gdays)
    mf, df_ = G + "montrg_auto_model_flag", G + "montrg_auto_data_flag"
    multi(48, "GenAI monitoring", "genai_monitoring", lambda c: c("gv").filter(running), gsig, ("indicator", "significance"), [
        ("model_monitoring_flag_missing", yes, blank(mf)), ("data_monitoring_flag_missing", yes, blank(df_)),
        ("model_exclusion_reason_missing", falsehood(mf), blank(G + "montrg_auto_exclude_reason_model_array")),
        ("data_exclusion_reason_missing", falsehood(df_), blank(G + "montrg_auto_exclude_reason_data_array")),
        ("last_result_missing_or_stale", truth(mf) | truth(df_), _stale(G + "montrg_last_rslt_dttm", as_of))], GV, "GENAI")
    multi(49, "GenAI key metric gaps", "genai_metrics", lambda c: c("gv"), gsig, ("indicator", "significance"), [
        ("metric_code_missing", yes, blank(G + "metric_key_code")), ("metric_value_missing", yes, blank(G + "metric_key_val")),
        ("auto_assessment_missing", yes, blank(G + "metric_assmnt_auto_cmnt_txt"))], GV, "GENAI")
    plan = F.col(G + "fin_effect_plan_million_qty").try_cast("double")
    fact = F.col(G + "fin_effect_fact_million_qty").try_cast("double")
    multi(50, "GenAI effect and usage limits", "genai_usage", lambda c: c("gv"), gsig, ("indicator", "significance"), [
        ("financial_plan_missing", yes, plan.isNull()),
        ("financial_fact_missing_or_below_plan", F.coalesce(plan > 0, F.lit(False)), fact.isNull() | (fact < plan)),
        ("usage_days_limit_missing", yes, F.col(G + "usg_days_qty").isNull()),
        ("concurrent_usage_limit_missing", yes, F.col(G + "usg_same_time_cnt").isNull())], GV, "GENAI")
    return out


SHAPE = ("dim_1_value", "dim_2_value", "metric_value", "numerator", "denominator")


def result(q: Query, c: Context) -> DataFrame:
    """One query in the common five-column shape."""
    df = q.base(c)
    if q.kind == "rows":
        return df.select(*SHAPE)
    if q.kind == "dist":
        return m.dist(df, q.d1, q.d2)
    if q.kind == "gap":
        return m.gap(df, q.indicators[0][2], q.d1, q.d2)
    if q.kind == "days":
        return m.duration_quantiles(df, q.d1, q.days, {"p50": 0.5, "p90": 0.9})
    if q.extra == "swap":                      # the indicator is the second dimension
        r = m.indicator_gaps(df, q.indicators, q.days)
        return r.select(F.col("dim_2_value").alias("dim_1_value"), F.col("dim_1_value").alias("dim_2_value"), *SHAPE[2:])
    r = m.indicator_gaps(df, q.indicators, q.d2)
    if q.days is not None:
        slow = m.duration_quantiles(df, q.d2, q.days, {"p90": 0.9})
        r = r.unionByName(slow.select(
            F.lit("duration_p90_days").alias("dim_1_value"), F.col("dim_1_value").alias("dim_2_value"), *SHAPE[2:]))
    return r


def labelled(q: Query, df: DataFrame, as_of: str) -> DataFrame:
    return df.select(
        F.lit(q.id).alias("query_id"), F.lit(q.name).alias("query_name"), F.lit(q.domain).alias("risk_domain"),
        F.lit(q.entity).alias("entity_type"), F.lit(q.metric).alias("metric_name"),
        F.lit(q.dims[0]).alias("dim_1_name"), F.coalesce("dim_1_value", F.lit(NULL_DIM)).alias("dim_1_value"),
        F.lit(q.dims[1]).alias("dim_2_name"), F.coalesce("dim_2_value", F.lit(ALL_DIM)).alias("dim_2_value"),
        "metric_value", "numerator", "denominator", F.lit(as_of).cast("date").alias("as_of_dt"),
    )


def details(q: Query, c: Context) -> DataFrame:
    """Rows counted in a numerator and tied to a version; queries without one give none."""
    if q.kind not in ("gap", "multi"):
        raise ValueError(f"query {q.id} has no offending rows")
    df = q.base(c)
    version = "genai_ver_sid" if q.entity == "GENAI" else "model_ver_sid"
    if version not in df.columns:
        df = df.withColumn(version, F.lit(None).cast("string"))
    items = F.array(*[
        F.struct(F.lit(n).alias("issue_name"), (a & b).alias("bad")) for n, a, b in q.indicators
    ])
    rows = df.select(
        F.col(version).cast("string").alias("version_sid"), F.col(q.source[1]).cast("string").alias("source_entity_sid"), F.inline(items)
    ).filter("bad").filter(~blank("version_sid"))
    return rows.select(
        F.lit(q.id).alias("query_id"), F.lit(q.entity).alias("entity_type"), "version_sid",
        F.lit(q.source[0]).alias("source_entity_type"), "source_entity_sid", "issue_name",
    ).distinct()
