"""Statuses of 20 required fields per version in production, and their statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import (
    EXCEPTION, MISSING, NOT_APPLICABLE_TEXT, NOT_CHECKED, OK, field_status, has_value, truth,
)
from ..operators.measures import value_list
from ..operators.state import drop_deleted

FIELDS = (
    "model_identification", "model_version_date", "operation_start", "operation_end", "owner", "developer", "user",
    "target_segment", "business_process", "significance", "documentation", "source_code", "validation_result",
    "manual_monitoring_result", "auto_monitoring_result", "validation_data", "manual_monitoring_data",
    "auto_monitoring_data", "change_history", "financially_significant_change_history",
)


def version_context(versions: DataFrame, models: DataFrame, analytics: DataFrame) -> DataFrame:
    """Versions in production with analytics values first and the version's own as fallback."""
    meta = ("start_dt", "end_dt", "ctl_action", "ctl_datechange", "model_ver_stts_name")
    a = analytics.drop(*meta, "model_ver_prom_sid", "model_ver_busn_proc_code").withColumnsRenamed({
        "model_ver_signfcnt_ctgry_code": "a_significance", "model_ver_signfcnt_lvl_name": "a_level"})
    joined = versions.drop(*meta[:4], "model_ver_busn_proc_code").join(models.drop(*meta[:4]), "model_sid").join(
        a.join(analytics.select("model_ver_sid", "model_ver_busn_proc_code"), "model_ver_sid", "left"), "model_ver_sid", "left")
    return joined.filter(truth("model_ver_prom_expl_flag")).withColumns({
        "operation_start": F.coalesce("model_ver_prom_actual_implm_first_dttm", "model_ver_prom_implm_first_dttm"),
        "operation_end": F.coalesce("model_ver_prom_actual_expl_output_dttm", "model_ver_prom_expl_output_dttm"),
        "significance": F.coalesce("a_significance", "model_ver_signfcnt_ctgry_code"),
        "significance_level": F.coalesce("a_level", "model_ver_signfcnt_lvl_name"),
    })


def _flag(c: Column, name: str) -> Column:
    return F.max(c.cast("int")).alias(name)


def validation_evidence(valid: DataFrame) -> DataFrame:
    v = drop_deleted(valid)
    facts = v.groupBy("model_ver_sid").agg(
        F.countDistinct("valid_sid").alias("validation_count"),
        _flag(has_value("valid_rslt_name") | has_value("valid_report_sid"), "validation_present"),
        _flag(truth("valid_not_sample_data_flag"), "validation_no_sample"),
    )
    return facts.join(value_list(v, "model_ver_sid", "valid_rslt_name", "validation_results"), "model_ver_sid", "left")


def monitoring_evidence(links: DataFrame, results: DataFrame, kind: str) -> DataFrame:
    """Evidence per version through its monitorings; results are reduced per monitoring first."""
    m = f"montrg_{kind}"
    per_monitor = drop_deleted(results).groupBy(f"{m}_sid").agg(
        F.countDistinct(f"{m}_rslt_sid").alias("n"),
        _flag(has_value(f"{m}_rslt_name") | has_value(f"{m}_rslt_report_sid"), "p"),
        _flag(truth(f"{m}_rslt_valid_not_sample_data_flag"), "x"),
    )
    pairs = drop_deleted(links).select("model_ver_sid", f"{m}_sid").distinct()
    return pairs.join(per_monitor, f"{m}_sid", "left").groupBy("model_ver_sid").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(f"{kind}_results"),
        F.coalesce(F.max("p"), F.lit(0)).alias(f"{kind}_present"),
        F.coalesce(F.max("x"), F.lit(0)).alias(f"{kind}_no_sample"),
    )


def sample_evidence(samples: DataFrame) -> DataFrame:
    info = has_value("sample_data_addtnl_info_txt")
    return drop_deleted(samples).groupBy("model_ver_sid").agg(
        _flag(has_value("valid_sid") & info, "valid_data"),
        _flag(has_value("montrg_manual_rslt_sid") & info, "manual_data"),
        _flag(has_value("montrg_auto_rslt_sid") & info, "auto_data"),
    )


def change_evidence(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    live = drop_deleted(log)
    kind = F.upper("ent_type_name")
    of_version = F.upper("ent_param_chg_sid").startswith("MODEL_VERSION_") | kind.isin("MODEL_VERSION", "MODEL_VER")
    versions = live.filter(of_version).groupBy(F.col("ent_sid").alias("model_ver_sid")).agg(F.count(F.lit(1)).alias("version_changes"))
    models = live.filter(kind == "MODEL").groupBy(F.col("ent_sid").alias("model_sid")).agg(F.count(F.lit(1)).alias("model_changes"))
    return versions, models


def reference_links(samples: DataFrame, valid: DataFrame) -> DataFrame:
    """Report ids and data locations per version in long form; a version may have any number."""
    s = drop_deleted(samples)
    kinds = (("validation_data", "valid_sid"), ("manual_monitoring_data", "montrg_manual_rslt_sid"), ("auto_monitoring_data", "montrg_auto_rslt_sid"))
    parts = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.when(has_value(c), F.col("sample_data_addtnl_info_txt")).alias("value")) for k, c in kinds
    ])
    links = s.select("model_ver_sid", F.inline(parts))
    reports = drop_deleted(valid).select("model_ver_sid", F.lit("validation_report").alias("kind"), F.col("valid_report_sid").alias("value"))
    return links.unionByName(reports).filter("value is not null and model_ver_sid is not null").distinct()


def _ok_else(ok: Column, *exceptions: Column) -> Column:
    out = F.when(ok, F.lit(OK))
    for e in exceptions:
        out = out.when(e, F.lit(EXCEPTION))
    return out.otherwise(F.lit(MISSING))


def build_statuses(context: DataFrame, valid: DataFrame, manual: tuple[DataFrame, DataFrame], auto: tuple[DataFrame, DataFrame],
                   samples: DataFrame, log: DataFrame) -> DataFrame:
    """One row per version in production with 20 ``status_*`` columns."""
    versions, models = change_evidence(log)
    d = (
        context.join(validation_evidence(valid), "model_ver_sid", "left")
        .join(monitoring_evidence(*manual, "manual"), "model_ver_sid", "left")
        .join(monitoring_evidence(*auto, "auto"), "model_ver_sid", "left")
        .join(sample_evidence(samples), "model_ver_sid", "left")
        .join(versions, "model_ver_sid", "left").join(models, "model_sid", "left")
    )

    def on(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)) > 0

    def every(*cols: str) -> Column:
        out = has_value(cols[0])
        for c in cols[1:]:
            out = out & has_value(c)
        return out

    def na(c: str) -> Column:
        return F.coalesce(F.lower(F.trim(c)).isin(*NOT_APPLICABLE_TEXT), F.lit(False))

    V = "model_ver_"
    no_valid = truth(V + "not_valid_flag")
    excluded = has_value(V + "montrg_auto_exclude_reason_array")
    statuses = (
        _ok_else(every("model_code", "model_name")),
        field_status(V + "crtn_dttm", allow_na=False),
        field_status("operation_start", allow_na=False),
        _ok_else(has_value("operation_end"), truth(V + "prom_expl_flag")),
        _ok_else(every(V + "owner_cont_name", V + "owner_dprtmt_name", V + "owner_block_name")),
        _ok_else(every(V + "dev_dprtmt_cont_name", V + "dev_dprtmt_name", V + "dev_block_name")),
        _ok_else(every(V + "employer_block_name", V + "employer_dprtmt_name")),
        field_status(V + "risk_sgmnt_name"), field_status(V + "busn_proc_code"), field_status("significance"),
        _ok_else(has_value(V + "dev_report_sid") | has_value(V + "other_docs_sid") | has_value("model_other_docs_sid"),
                 na(V + "other_docs_sid") | na("model_other_docs_sid")),
        _ok_else(has_value(V + "repstry_link_txt") | has_value(V + "implm_repstry_link_txt"),
                 has_value(V + "repstry_non_link_reason_name") | has_value(V + "repstry_non_link_reason_cmnt_txt")),
        _ok_else(on("validation_present"), no_valid),
        _ok_else(on("manual_present")),
        _ok_else(on("auto_present"), excluded),
        _ok_else(on("valid_data"), no_valid | on("validation_no_sample")),
        _ok_else(on("manual_data"), on("manual_no_sample")),
        _ok_else(on("auto_data"), on("auto_no_sample") | excluded),
        _ok_else(on("version_changes") | on("model_changes")),
        F.lit(NOT_CHECKED),
    )
    return d.select("model_sid", "model_ver_sid", *[s.alias(f"status_{n}") for n, s in zip(FIELDS, statuses)])


def field_statistics(statuses: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Counts of OK, violations and not-applicable per field; percent among the applicable."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"status_{n}").alias("status")) for n in fields])
    long = statuses.select("model_sid", F.inline(pairs))
    na = F.col("status").isin(EXCEPTION, NOT_CHECKED)

    def n(c: Column) -> Column:
        return F.sum(c.cast("long"))

    agg = long.groupBy("field").agg(
        F.count(F.lit(1)).alias("versions"), F.countDistinct("model_sid").alias("models"),
        n(F.col("status") == OK).alias("ok"), n(F.col("status") == MISSING).alias("violations"), n(na).alias("not_applicable"),
    )
    return agg.withColumn(
        "violation_pct",
        F.round(F.try_divide(F.lit(100.0) * F.col("violations"), F.col("versions") - F.col("not_applicable")), 2))


def labels_by_status(statuses: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Per version: fields by status as text, counts, and the overall status."""
    items = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"status_{n}").alias("s")) for n in fields])
    out = statuses.select("model_ver_sid", items.alias("i"))

    def names(status: str) -> Column:
        return F.array_join(F.transform(F.filter("i", lambda x: x.s == status), lambda x: x.n), "; ")

    def size(status: str) -> Column:
        return F.size(F.filter("i", lambda x: x.s == status))

    return out.select(
        "model_ver_sid", names(MISSING).alias("missing_fields"), names(EXCEPTION).alias("exception_fields"),
        names(NOT_CHECKED).alias("unchecked_fields"), size(MISSING).alias("missing_count"), size(OK).alias("ok_count"),
        F.when(size(MISSING) > 0, F.lit(MISSING)).when(size(NOT_CHECKED) > 0, F.lit(NOT_CHECKED)).otherwise(F.lit(OK)).alias("overall_status"),
    )


def from_tables(raw: Callable[[str], DataFrame], current: Callable[[str], DataFrame]) -> DataFrame:
    """Statuses straight from the registry tables."""
    context = version_context(current("model_ver"), current("model"), current("model_ver_anlt_dtl"))
    return build_statuses(
        context, raw("valid"), (raw("model_ver_x_montrg_manual"), raw("montrg_manual_rslt")),
        (raw("model_ver_x_montrg_auto"), raw("montrg_auto_rslt")), raw("sample_data"), raw("ent_param_chg"))
