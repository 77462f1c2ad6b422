"""31 development controls over versions, validations, samples and metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_end, days_late, duration_days, real_date
from ..functions.predicates import (
    artifact_missing, blank, clean_dim, numeric_parseable, status_like, truth, uuid_list,
)
from ..operators.measures import above_group_quantile, any_by
from ..operators.relate import resolve_parent
from .spec import Control

# --- fixed values: status patterns -------------------------------------------
DEV_STATUS = "BACKLOG|DEVELOPMENT|TRAIN_VALIDATION|VERIFICATION|AWAITING_VALIDATION"
STARTED_STATUS = "DEVELOPMENT|TRAIN_VALIDATION|VERIFICATION|AWAITING_VALIDATION"
GATE_STATUS = (
    "TRAIN_VALIDATION|VERIFICATION|AWAITING_VALIDATION|DECISION_MAKING|PILOTING_PERMITTED|EXPLOIT_PERMITTED"
)
IN_DEVELOPMENT = "MODEL_VERSION_DEVELOPMENT$"
CLOSED_MODEL_STATUS = "CANCEL|CANCELED|ARCHIV|REJECT"
FINAL_VALID_STATUS = "DONE|COMPLETE|RESULTS_APPROVE"
EXCLUDED_VALID_STATUS = "CANCEL|CANCELED|NOT_NEEDED|SUSPENDED|REJECT"
NEGATIVE_VALID_STATUS = "DONE_NEGATIVE"
RED = "КРАСН|RED"
RED_YELLOW = "КРАСН|Ж[ЕЁ]ЛТ|RED|YELLOW"
SAMPLE_WITH_METRIC = "ТЕСТ|ВАЛИДАЦ"
RETURN_NO_DATA = "НЕ ПРЕДОСТАВЛЕНЫ ДАННЫЕ"
RETURN_NO_ACCESS = "НЕ ПРЕДОСТАВЛЕН ДОСТУП"
RETURN_NO_SAMPLE_INFO = "НЕ ПРЕДОСТАВЛЕНА ИНФОРМАЦИЯ.*ФОРМИРОВАНИЯ ВАЛИДАЦИОННЫХ ВЫБОРОК"
MIN_GROUP_FOR_P90 = 5
ENTITIES = ("MODEL_VER", "SAMPLE_DATA", "METRIC", "SAMPLE_METRIC", "VALIDATION", "MODEL_VER_VALIDATION")
# ------------------------------------------------------------------------------

PLAN_START, PLAN_END = "model_ver_dev_start_plan_dttm", "model_ver_dev_end_plan_dttm"
FACT_START, FACT_END = "model_ver_dev_start_fact_dttm", "model_ver_dev_end_fact_dttm"


# Contract: the columns the controls read from each table.
COLUMNS = {
    "model_ver": (
        "model_ver_sid", "model_sid", "model_ver_stts_name", "model_ver_signfcnt_ctgry_code", "model_ver_owner_dprtmt_name",
        "model_ver_dev_dprtmt_name", "model_ver_method_name", "model_ver_data_type_name", PLAN_START, PLAN_END, FACT_START, FACT_END,
        "model_ver_dev_report_sid", "model_ver_prevalid_flag", "model_ver_prevalid_rslt_name", "model_ver_llm_flag",
        "model_ver_llm_descr_txt", "model_ver_proj_feature_flag", "model_ver_proj_feature_sid", "model_ver_repstry_link_txt",
        "model_ver_repstry_commit_sid", "model_ver_crtn_dttm",
    ),
    "valid": (
        "valid_sid", "model_ver_sid", "valid_stts_name", "valid_rslt_name", "valid_end_fact_dttm", "valid_dev_return_reason_txt",
        "valid_prblm_name", "valid_start_fact_dttm", "valid_crtn_dttm",
    ),
    "sample_data": ("sample_data_sid", "model_ver_sid", "valid_sid", "sample_data_type_name", "sample_data_not_metric_calc_flag"),
    "metric": ("metric_sid", "sample_data_sid", "metric_name", "metric_val"),
}

#: Of these, what no control asks for: shown next to findings only.
SHOWN_ONLY = ("model_sid", "model_ver_crtn_dttm", "valid_start_fact_dttm", "valid_crtn_dttm")


def active_versions(mv: DataFrame) -> DataFrame:
    return mv.filter(~status_like("model_ver_stts_name", CLOSED_MODEL_STATUS))


def completed_validations(valid: DataFrame) -> DataFrame:
    return valid.filter(
        ~status_like("valid_stts_name", EXCLUDED_VALID_STATUS)
        & (status_like("valid_stts_name", FINAL_VALID_STATUS) | real_date("valid_end_fact_dttm"))
    )


def bases(mv: DataFrame, valid: DataFrame, sample: DataFrame, metric: DataFrame,
          hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, Callable[[], DataFrame]]:
    """Lazily built base frames, one per kind of entity the controls look at.

    ``hold`` keeps what several base frames read (samples with their version, completed validations).
    """
    kept: dict[str, DataFrame] = {}

    def once(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in kept:
            kept[name] = hold(make())
        return kept[name]

    def versions() -> DataFrame:
        return active_versions(mv)

    def short_versions() -> DataFrame:
        return versions().select("model_ver_sid", "model_ver_dev_dprtmt_name", "model_ver_signfcnt_ctgry_code")

    def durations() -> DataFrame:
        d = versions().filter(real_date(FACT_START) & real_date(FACT_END)).select(
            "model_ver_sid", "model_ver_stts_name", clean_dim("model_ver_dev_dprtmt_name").alias("department"),
            duration_days(FACT_END, FACT_START).alias("days"),
        )
        return above_group_quantile(d, "department", "days", 0.90, MIN_GROUP_FOR_P90)

    def samples() -> DataFrame:
        return once("samples", linked_samples)

    def linked_samples() -> DataFrame:
        s = resolve_parent(
            sample.select("sample_data_sid", "model_ver_sid", "valid_sid", "sample_data_type_name", "sample_data_not_metric_calc_flag"),
            valid, "valid_sid", "model_ver_sid", "resolved_sid",
        ).drop("model_ver_sid")
        return s.join(short_versions(), s["resolved_sid"] == F.col("model_ver_sid")).drop("resolved_sid")

    def samples_with_metric() -> DataFrame:
        have = any_by(metric, "sample_data_sid", F.col("metric_sid").isNotNull() & ~blank("metric_val"), "has_metric")
        return samples().join(have, "sample_data_sid", "left")

    def metrics() -> DataFrame:
        return metric.select("metric_sid", "sample_data_sid", "metric_name", "metric_val").join(samples(), "sample_data_sid")

    def metric_groups() -> DataFrame:
        named = metrics().filter(~blank("metric_name"))
        return named.groupBy(
            "model_ver_sid", "sample_data_sid", clean_dim("sample_data_type_name").alias("sample_type"),
            F.upper(F.trim("metric_name")).alias("metric_key"),
        ).agg(F.count(F.lit(1)).alias("repeats"))

    def returns() -> DataFrame:
        r = valid.filter(~blank("valid_dev_return_reason_txt")).select(
            "model_ver_sid", "valid_sid", F.upper("valid_dev_return_reason_txt").alias("reason")
        )
        return r.join(short_versions(), "model_ver_sid")

    def completed() -> DataFrame:
        return once("completed", completed_with_version)

    def completed_with_version() -> DataFrame:
        c = completed_validations(valid).select(
            "model_ver_sid", "valid_sid", "valid_stts_name", "valid_rslt_name", "valid_prblm_name",
            "valid_dev_return_reason_txt",
        )
        return c.join(short_versions(), "model_ver_sid")

    def version_outcomes() -> DataFrame:
        negative = status_like("valid_stts_name", NEGATIVE_VALID_STATUS) | status_like("valid_rslt_name", RED)
        bad = ~blank("valid_dev_return_reason_txt") | status_like("valid_rslt_name", RED_YELLOW)
        return completed().groupBy(
            "model_ver_sid", "model_ver_dev_dprtmt_name", "model_ver_signfcnt_ctgry_code"
        ).agg(F.sum(negative.cast("int")).alias("negatives"), F.max(bad.cast("int")).alias("bad_outcome"))

    return {
        "versions": versions, "durations": durations, "samples": samples_with_metric, "metrics": metrics,
        "metric_groups": metric_groups, "returns": returns, "completed": completed,
        "version_outcomes": version_outcomes,
    }


def controls(as_of: str) -> list[Control]:
    st = "model_ver_stts_name"
    dev, started, gate = (status_like(st, p) for p in (DEV_STATUS, STARTED_STATUS, GATE_STATUS))
    in_dev = status_like(st, IN_DEVELOPMENT)
    every = F.lit(True)
    department = ("department", clean_dim("model_ver_dev_dprtmt_name"))
    status = ("status", clean_dim(st))
    significance = ("significance", clean_dim("model_ver_signfcnt_ctgry_code"))
    sample_type = ("sample_type", clean_dim("sample_data_type_name"))
    now = as_of_end(as_of)

    def real(*cols: str) -> Column:
        cond = every
        for c in cols:
            cond = cond & real_date(c)
        return cond

    def timeline(i, name, severity, applies, issue, issue_name, reason, d2=status):
        return Control(i, name, "development_timeline", severity, "versions", applies, issue, department, d2, issue_name, reason)

    def field(i, name, domain, severity, applies, issue, issue_name, reason, d1=significance):
        return Control(i, name, domain, severity, "versions", applies, issue, d1, status, issue_name, reason)

    def returned(i, name, pattern, issue_name):
        return Control(i, name, "development_outcome", "HIGH", "returns", every, F.col("reason").rlike(pattern), department,
                       significance, issue_name, "no validation carries a return reason", "VALIDATION", "valid_sid")

    report, repo, commit, feature = (
        "model_ver_dev_report_sid", "model_ver_repstry_link_txt", "model_ver_repstry_commit_sid", "model_ver_proj_feature_sid",
    )
    problem = F.when(blank("valid_prblm_name"), F.lit("adverse_validation_without_problem_type")).otherwise(
        F.concat(F.lit("adverse_validation:"), F.regexp_replace(F.trim("valid_prblm_name"), r"\s+", " "))
    )
    return [
        timeline(1, "Planned start after planned end", "HIGH", dev & real(PLAN_START, PLAN_END),
                 F.col(PLAN_START) > F.col(PLAN_END), "planned_start_after_planned_end", "no version has both planned dates"),
        timeline(2, "Actual end before actual start", "HIGH", real(FACT_START, FACT_END),
                 F.col(FACT_END) < F.col(FACT_START), "actual_end_before_actual_start", "no version has both actual dates"),
        timeline(3, "Actual development date in the future", "HIGH", dev & (real(FACT_START) | real(FACT_END)),
                 (real(FACT_START) & (F.col(FACT_START) > now)) | (real(FACT_END) & (F.col(FACT_END) > now)),
                 "future_actual_development_date", "no version has an actual date"),
        timeline(4, "Development open although an end is recorded", "MEDIUM", in_dev, real(FACT_END),
                 "development_status_with_actual_end", "no version is in development"),
        timeline(5, "Past the gate without an actual end", "HIGH", gate, ~real(FACT_END),
                 "post_development_status_without_actual_end", "no version is past development"),
        timeline(6, "Development started after plan", "MEDIUM", dev & real(PLAN_START, FACT_START),
                 F.col(FACT_START) > F.col(PLAN_START), "actual_start_after_plan", "no version has planned and actual start"),
        timeline(7, "Open development without a planned end", "MEDIUM", in_dev, ~real(PLAN_END),
                 "open_development_without_planned_end", "no version is in development", significance),
        timeline(8, "Development finished after plan", "HIGH", real(PLAN_END, FACT_END),
                 F.col(FACT_END) > F.col(PLAN_END), "development_completed_late", "no version has planned and actual end", significance),
        Control(9, "Duration above the department's p90", "development_timeline", "MEDIUM", "durations", every, F.col("above"),
                ("department", F.col("department")), status, "duration_above_department_p90", "too few finished developments for a p90"),
        field(10, "Data type missing", "development_metadata", "HIGH", started, blank("model_ver_data_type_name"),
              "data_type_missing", "no version has started"),
        field(11, "Modelling method missing", "development_metadata", "HIGH", started, blank("model_ver_method_name"),
              "modeling_method_missing", "no version has started"),
        field(12, "Significance missing before validation", "development_governance", "HIGH", gate,
              blank("model_ver_signfcnt_ctgry_code"), "significance_missing_at_gate", "no version is at the gate", department),
        field(13, "Owner department missing", "development_governance", "HIGH", dev, blank("model_ver_owner_dprtmt_name"),
              "owner_department_missing", "no version is in the development scope"),
        field(14, "Development department missing", "development_governance", "HIGH", started, blank("model_ver_dev_dprtmt_name"),
              "development_department_missing", "no version has started"),
        field(15, "Language-model version without description", "development_metadata", "MEDIUM", dev & truth("model_ver_llm_flag"),
              blank("model_ver_llm_descr_txt"), "llm_description_missing", "no version sets the flag", department),
        Control(16, "Applicable sample without a metric", "development_data", "HIGH", "samples",
                status_like("sample_data_type_name", SAMPLE_WITH_METRIC) & ~truth("sample_data_not_metric_calc_flag"),
                F.coalesce("has_metric", F.lit(0)) == 0, sample_type, significance, "applicable_sample_without_metric",
                "no applicable linked sample", "SAMPLE_DATA", "sample_data_sid"),
        Control(17, "Metric value is not a number", "development_data", "MEDIUM", "metrics", ~blank("metric_val"),
                ~numeric_parseable("metric_val"), ("metric", clean_dim("metric_name")), sample_type, "metric_value_not_numeric",
                "no linked metric value", "METRIC", "metric_sid"),
        Control(18, "Metric repeated within a sample", "development_data", "MEDIUM", "metric_groups", every, F.col("repeats") > 1,
                ("metric", F.col("metric_key")), ("sample_type", F.col("sample_type")), "duplicate_metric_for_sample",
                "no linked named metric", "SAMPLE_METRIC", F.concat_ws(":", "sample_data_sid", "metric_key")),
        field(19, "Development report missing before validation", "development_evidence", "HIGH", gate, artifact_missing(report),
              "development_report_missing_at_gate", "no version is at the gate"),
        field(20, "Report id is not a UUID or list of UUIDs", "development_evidence", "MEDIUM", gate & ~artifact_missing(report),
              ~uuid_list(report), "development_report_id_invalid", "no version carries a report id"),
        field(21, "Prevalidated without a result", "development_prevalidation", "MEDIUM", started & truth("model_ver_prevalid_flag"),
              blank("model_ver_prevalid_rslt_name"), "prevalidation_result_missing", "no version sets the flag"),
        field(22, "Feature-store id without the flag", "source_data_quality", "MEDIUM", dev & ~artifact_missing(feature),
              ~truth("model_ver_proj_feature_flag"), "feature_store_sid_without_true_flag", "no version carries a feature-store id"),
        returned(23, "Returned: data not provided", RETURN_NO_DATA, "validation_return_missing_data"),
        returned(24, "Returned: no access to data", RETURN_NO_ACCESS, "validation_return_no_data_access"),
        returned(25, "Returned: too little information for samples", RETURN_NO_SAMPLE_INFO,
                 "validation_return_insufficient_sample_information"),
        Control(26, "Repeated negative validation", "development_outcome", "HIGH", "version_outcomes", every, F.col("negatives") > 1,
                department, significance, "repeated_negative_validation", "no completed validation", "MODEL_VER_VALIDATION"),
        Control(27, "Red or yellow results by problem", "development_outcome", "HIGH", "completed", every,
                status_like("valid_rslt_name", RED_YELLOW), department, ("result", clean_dim("valid_rslt_name")), problem,
                "no completed validation", "VALIDATION", "valid_sid"),
        Control(28, "Version with a return or an adverse result", "development_outcome", "HIGH", "version_outcomes", every,
                F.col("bad_outcome") == 1, department, significance, "negative_development_outcome", "no completed validation",
                "MODEL_VER_VALIDATION"),
        field(29, "Repository without commit", "development_reproducibility", "HIGH", started & ~artifact_missing(repo),
              artifact_missing(commit), "repository_without_commit", "no version carries a repository link"),
        field(30, "Commit without repository", "development_reproducibility", "HIGH", started & ~artifact_missing(commit),
              artifact_missing(repo), "commit_without_repository", "no version carries a commit id"),
        field(31, "Feature store on, project id missing", "source_data_quality", "MEDIUM", dev & truth("model_ver_proj_feature_flag"),
              artifact_missing(feature), "feature_store_true_without_project_sid", "no version sets the flag"),
    ]


def schedule_columns(mv: DataFrame) -> DataFrame:
    """Schedule deviations and durations in days next to the four development dates."""
    def d(end: str, start: str) -> Column:
        return F.round(duration_days(end, start), 2)

    return mv.select(
        "model_ver_sid",
        d(FACT_START, PLAN_START).alias("start_deviation_days"),
        d(FACT_END, PLAN_END).alias("end_deviation_days"),
        d(PLAN_END, PLAN_START).alias("planned_duration_days"),
        d(FACT_END, FACT_START).alias("actual_duration_days"),
        days_late(FACT_END, PLAN_END).alias("end_days_late"),
    )


#: Which of the four development dates explain a finding of which control.
DATES_OF = {
    1: (PLAN_START, PLAN_END), 2: (FACT_START, FACT_END), 3: (FACT_START, FACT_END), 4: (FACT_START, FACT_END), 5: (FACT_START, FACT_END),
    6: (PLAN_START, FACT_START), 7: (PLAN_START, PLAN_END), 8: (PLAN_END, FACT_END), 9: (PLAN_START, FACT_START, PLAN_END, FACT_END),
}
RETURNED = (23, 24, 25)


def enriched_detail(detail: DataFrame, mv: DataFrame, valid: DataFrame, metric: DataFrame, durations: DataFrame, metric_groups: DataFrame,
                    hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Detail rows with the figures behind them; a column is filled only for the controls that it explains.

    Dates for the timeline controls, deviations in days, the department's p90, raw metric values, numbers of
    repeats, and the validation of a return. Every side has one row per key. A side meets only the findings that it
    explains; ``hold`` keeps the findings, which are read once per side.
    """
    q = F.col("query_id")

    def only(ids: Sequence[int], c: str, name: str) -> Column:
        return F.when(q.isin(*ids), F.col(c)).alias(name)

    plan = mv.select("model_ver_sid", PLAN_START, FACT_START, PLAN_END, FACT_END).join(schedule_columns(mv).drop("end_days_late"), "model_ver_sid")
    long = durations.select(F.col("model_ver_sid").alias("_dv"), F.round("limit", 2).alias("_p90"), F.round("days", 2).alias("_days"))
    values = metric.select(F.col("metric_sid").alias("_ms"), F.col("metric_name").alias("_mn"), F.col("metric_val").alias("_mv"))
    repeats = metric_groups.select(F.col("model_ver_sid").alias("_gv"), F.concat_ws(":", "sample_data_sid", "metric_key").alias("_gs"), F.col("repeats").alias("_repeats"))
    checks = valid.select(
        F.col("valid_sid").alias("_vs"), F.col("model_ver_sid").alias("_vv"), "valid_crtn_dttm", "valid_start_fact_dttm", "valid_end_fact_dttm", "valid_stts_name",
        "valid_rslt_name", "valid_dev_return_reason_txt")
    sid, ver = F.col("source_entity_sid"), F.col("model_ver_sid")
    found = hold(detail.select("query_id", "model_ver_sid", "source_entity_type", "source_entity_sid", "issue_name"))
    sides = [
        ((9,), long, ver == F.col("_dv")), ((17,), values, sid == F.col("_ms")), ((18,), repeats, (ver == F.col("_gv")) & (sid == F.col("_gs"))),
        (RETURNED, checks, (sid == F.col("_vs")) & (ver == F.col("_vv")))]
    explained = [found.filter(q.isin(*ids)).join(side, on, "left") for ids, side, on in sides]
    others = found.filter(~F.coalesce(q.isin(*[i for ids, *_ in sides for i in ids]), F.lit(False)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*explained, others]).join(plan, "model_ver_sid", "left")
    dates = {c: [i for i, cols in DATES_OF.items() if c in cols] for c in (PLAN_START, FACT_START, PLAN_END, FACT_END)}
    return rows.select(
        "query_id", "model_ver_sid", "source_entity_type", "source_entity_sid", "issue_name",
        only(dates[PLAN_START], PLAN_START, "planned_start"), only(dates[FACT_START], FACT_START, "actual_start"),
        only(dates[PLAN_END], PLAN_END, "planned_end"), only(dates[FACT_END], FACT_END, "actual_end"),
        only((6,), "start_deviation_days", "start_deviation_days"), only((8, 9), "end_deviation_days", "end_deviation_days"),
        only((9,), "planned_duration_days", "planned_duration_days"), only((9,), "actual_duration_days", "actual_duration_days"),
        F.col("_p90").alias("expected_days_p90"), F.col("_days").alias("checked_days"), F.col("_mn").alias("metric_name"), F.col("_mv").alias("metric_value"),
        F.col("_repeats").alias("repeats"), F.col("valid_crtn_dttm").alias("validation_created"), F.col("valid_start_fact_dttm").alias("validation_started"),
        F.col("valid_end_fact_dttm").alias("validation_ended"), F.col("valid_stts_name").alias("validation_status"), F.col("valid_rslt_name").alias("validation_result"),
        F.col("valid_dev_return_reason_txt").alias("return_reason"))
