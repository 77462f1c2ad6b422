"""Wide version card, status histories and the lifecycle event log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import cap_open_end
from ..functions.predicates import as_col, map_values
from .relate import union_named
from .state import join_latest, take_latest

Table = Callable[[str], DataFrame]

# --- fixed values ---------------------------------------------------------------
EXPLOIT_PERMITTED = "MODEL_PROM_VERSION_EXPLOIT_PERMITTED"
STAGES = {
    "business": "Business task set", "development": "Model development", "prevalidation": "Prevalidation",
    "validation": "Validation", "auto_monitoring": "Automatic monitoring", "prom": "Production version development",
    "it_validation": "IT validation", "implementation": "Implementation",
}
# --------------------------------------------------------------------------------

# Steps of the card after model and version: (table, key joined on, columns taken).
CARD_STEPS = (
    ("model_ver_anlt_dtl", "model_ver_sid", ("model_ver_stts_name", "model_stts_name", "model_ver_prom_expl_flag")),
    ("model_ver_x_busn_task", "model_ver_sid", ("busn_task_sid",)),
    ("model_ver_prom", "model_ver_sid", ("model_ver_prom_sid", "model_ver_prom_stts_name", "model_ver_prom_instr_name",
                                         "model_ver_prom_sys_name", "model_ver_prom_crtn_dttm", "model_ver_prom_dev_block_name", "model_ver_prom_dev_dprtmt_name")),
    ("model_ver_x_montrg_manual", "model_ver_sid", ("montrg_manual_sid",)),
    ("model_ver_x_montrg_auto", "model_ver_sid", ("montrg_auto_sid",)),
    ("valid", "model_ver_sid", ("valid_sid", "valid_crtn_dttm", "valid_report_sid", "valid_dprtmt_name")),
    ("busn_task", "busn_task_sid", ("busn_task_name", "busn_task_claim_descr_txt", "busn_task_crtn_dttm", "busn_task_employer_block_name",
                                   "busn_task_employer_dprtmt_name")),
    ("montrg_manual_rslt", "montrg_manual_sid", ("montrg_manual_rslt_start_dttm", "montrg_manual_rslt_end_dttm", "montrg_manual_rslt_report_sid")),
    ("montrg_auto", "montrg_auto_sid", ("montrg_auto_crtn_dttm", "montrg_auto_end_dttm", "montrg_auto_dprtmt_name")),
    ("valid_it", "model_ver_prom_sid", ("valid_it_sid", "valid_it_start_dttm", "valid_it_end_dttm", "valid_it_crtn_dttm", "valid_it_rslt_name", "valid_it_dprtmt_name")),
)
MODEL_COLUMNS = ("model_name", "model_code", "model_type_name", "model_subtype_name", "model_rsk_flag", "model_rsk_type_name", "model_rsk_sgmnt_name",
                 "model_conf_ctgry_name", "model_sel_secret_flag")
VERSION_COLUMNS = (
    "model_ver_sid", "model_sid", "model_ver_signfcnt_lvl_name", "model_ver_signfcnt_ctgry_code", "model_ver_signfcnt_ctgry_descr_txt",
    "model_ver_dev_start_fact_dttm", "model_ver_dev_end_fact_dttm", "model_ver_dev_sys_name", "model_ver_data_mart_link_txt",
    "model_ver_crtn_dttm", "model_ver_dev_report_sid", "model_ver_prevalid_report_file_sid", "model_ver_prevalid_report_link_sid",
    "model_ver_prevalid_report_link_txt", "model_ver_dev_block_name", "model_ver_dev_dprtmt_name", "model_ver_prevalid_dttm",
)

# --- fixed values: report headings of the card, in report order; a heading is the upper-case column name, a bar and this text ---
HEADINGS = {
    "model_name": "Наименование модели",
    "model_rsk_flag": "Флаг риск-модели",
    "model_rsk_type_name": "Тип риска модели",
    "model_rsk_sgmnt_name": "Наименование риск-сегмента модели",
    "model_type_name": "Тип модели",
    "model_subtype_name": "Подтип модели",
    "model_code": "Код модели",
    "model_conf_ctgry_name": "Категория конфиденциальности информации о модели",
    "model_sel_secret_flag": "Флаг коммерческой тайны",
    "model_sid": "Идентификатор модели",
    "model_ver_signfcnt_lvl_name": "Наименование степени значимости версии модели",
    "model_ver_dev_start_fact_dttm": "Фактическая дата-время начала разработки версии модели",
    "model_ver_signfcnt_ctgry_code": "Наименование категории значимости версии модели",
    "model_ver_signfcnt_ctgry_descr_txt": "Обоснование категории значимости версии модели",
    "model_ver_dev_end_fact_dttm": "Фактическая дата-время окончания разработки версии модели",
    "model_ver_dev_sys_name": "Система в которой разрабатывалась версия модели",
    "model_ver_data_mart_link_txt": "Ссылка на витрину данных для обучения версии модели",
    "model_ver_crtn_dttm": "Дата-время создания версии модели",
    "model_ver_dev_report_sid": "Идентификатор отчета о разработке версия модели",
    "model_ver_prevalid_report_file_sid": "Идентификатор файла с отчетом о превалидации версии модели",
    "model_ver_prevalid_report_link_sid": "Идентификатор ссылки на отчет о превалидации версии модели",
    "model_ver_prevalid_report_link_txt": "Ссылка на отчет о превалидации",
    "model_ver_dev_block_name": "Наименование блока разработки версии модели",
    "model_ver_dev_dprtmt_name": "Наименование подразделения разработки версии модели",
    "model_ver_sid": "Идентификатор версии модели",
    "model_ver_stts_name": "Наименование статуса версии модели",
    "model_stts_name": "Статус модели",
    "model_ver_prom_expl_flag": "Флаг нахождения версии модели в эксплуатации",
    "busn_task_sid": "Идентификатор бизнес-задачи",
    "model_ver_prom_instr_name": "Среда (инструмент) исполнения промышленной версии модели",
    "model_ver_prom_sys_name": "Система в которой реализована промышленная версия модели",
    "model_ver_prom_sid": "Идентификатор промышленной версии модели",
    "model_ver_prom_stts_name": "Статус промышленной версии модели",
    "model_ver_prom_crtn_dttm": "Дата-время создания промышленной версии модели",
    "model_ver_prom_dev_block_name": "Блок разработки промышленной версии модели",
    "model_ver_prom_dev_dprtmt_name": "Подразделение разработки промышленной версии модели",
    "montrg_manual_sid": "Идентификатор ручного мониторинга",
    "montrg_auto_sid": "Идентификатор автоматического мониторинга",
    "valid_crtn_dttm": "Дата-время создания валидации",
    "valid_sid": "Идентификатор валидации",
    "valid_report_sid": "Идентификатор отчета о валидации",
    "valid_dprtmt_name": "Подразделение, проводящее валидацию",
    "busn_task_name": "Наименование бизнес-задачи",
    "busn_task_claim_descr_txt": "Описание требований бизнес-задачи",
    "busn_task_crtn_dttm": "Дата-время создания бизнес-задачи",
    "busn_task_employer_block_name": "Блок заказчика бизнес-задачи",
    "busn_task_employer_dprtmt_name": "Наименование подразделения заказчика бизнес-задачи",
    "montrg_manual_rslt_end_dttm": "Дата-время окончания процесса ручного мониторинга в рамках которого получен текущий результат",
    "montrg_manual_rslt_start_dttm": "Дата-время начала процесса ручного мониторинга в рамках которого получен текущий результат",
    "montrg_manual_rslt_report_sid": "Идентификатор отчёта о результате ручного мониторинга",
    "montrg_auto_crtn_dttm": "Дата-время создания автоматического мониторинга",
    "montrg_auto_end_dttm": "Дата-время окончания мониторинга",
    "montrg_auto_dprtmt_name": "Наименование подразделения проводящего автоматического мониторинга",
    "valid_it_end_dttm": "Дата-время окончания ИТ-валидации",
    "valid_it_start_dttm": "Дата-время начала ИТ-валидации",
    "valid_it_crtn_dttm": "Дата-время создания ИТ-валидации",
    "valid_it_rslt_name": "Результат ИТ-валидации",
    "valid_it_dprtmt_name": "Подразделение проводящее ИТ-валидацию",
}
# ---------------------------------------------------------------------------------------------------------------------------------


def newest_first(df: DataFrame, key: str) -> list[Column]:
    """Newest by start date; every further column breaks ties so that the choice is total."""
    rest = sorted(c for c in df.columns if c not in (key, "start_dt"))
    return [F.col("start_dt").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]]


def assemble_card(table: Table) -> DataFrame:
    """One wide row per model: newest version, then the newest linked record of each kind."""
    models = take_latest(table("model"), ["model_sid"], newest_first(table("model"), "model_sid"))
    raw = table("model_ver").filter("model_sid is not null")
    versions = take_latest(raw, ["model_sid"], [F.col("start_dt").desc_nulls_last(), F.col("model_ver_sid").desc()])
    card = versions.select(*VERSION_COLUMNS).join(models.select("model_sid", *MODEL_COLUMNS), "model_sid")
    for name, key, fields in CARD_STEPS:
        right = table(name).select(key, "start_dt", *fields)
        card = join_latest(card, right, key, newest_first(right, key), fields)
    return card


def business_names(card: DataFrame) -> DataFrame:
    """The card under its report headings, in report order."""
    return card.select(*[F.col(c).alias(f"{c.upper()}|{text}") for c, text in HEADINGS.items()])


def status_history(ids: DataFrame, id_col: str, log: DataFrame, parameter: str, cutoff: str, as_of: str,
                   labels: Mapping[str, str]) -> DataFrame:
    """Status intervals of the listed entities with labels and capped open ends."""
    changes = log.filter((F.col("ent_param_chg_sid") == parameter) & (F.col("start_dttm") < F.lit(cutoff).cast("timestamp")))
    c = changes.select(
        F.col("ent_sid").cast("string").alias(id_col), map_values("ent_param_chg_val", labels).alias("life_stage"),
        "start_dttm", cap_open_end("end_dttm", as_of).alias("end_dttm"))
    return ids.select(id_col).distinct().join(c, id_col, "left")


def parameter_pair(ids: DataFrame, log: DataFrame, old: str, new: str) -> DataFrame:
    """Newest value of one parameter beside the newest value of another."""
    def newest(parameter: str, value: str) -> DataFrame:
        rows = log.filter(F.col("ent_param_chg_sid") == parameter).select(
            F.col("ent_sid").cast("string").alias("model_ver_sid"), F.col("ent_param_chg_val").alias(value), "start_dttm", "event_sid")
        mine = rows.join(ids.select("model_ver_sid").distinct(), "model_ver_sid", "left_semi")
        return take_latest(mine, ["model_ver_sid"], [F.col("start_dttm").desc_nulls_last(), F.col("event_sid").desc()])

    return newest(new, "new_value").select("model_ver_sid", "new_value", F.col("start_dttm").alias("changed_at")).join(
        newest(old, "old_value").select("model_ver_sid", "old_value"), "model_ver_sid", "left")


def change_stage(links: DataFrame, entity: str, log: DataFrame, parameters: Sequence[str], stage: str) -> DataFrame:
    """First and last change of a parameter set per version; the log is reduced per entity first."""
    spans = log.filter(F.col("ent_param_chg_sid").isin(*parameters)).groupBy(F.col("ent_sid").cast("string").alias(entity)).agg(
        F.min("start_dttm").alias("start_dt"), F.max("start_dttm").alias("end_dt"))
    return links.select("model_ver_sid", entity).filter(F.col(entity).isNotNull()).distinct().join(spans, entity).filter(
        "start_dt is not null").groupBy("model_ver_sid").agg(F.min("start_dt").alias("start_dt"), F.max("end_dt").alias("end_dt")).select(
        "model_ver_sid", F.lit(stage).alias("stage"), "start_dt", "end_dt")


def latest_link(table: Table, name: str, key: str, target: str, where: Column | None = None) -> DataFrame:
    df = table(name) if where is None else table(name).filter(where)
    right = df.select(key, target, "start_dt").filter(F.col(key).isNotNull())
    return take_latest(right, [key], newest_first(right, key)).select(key, target)


def event_log(ids: DataFrame, table: Table, log: DataFrame) -> DataFrame:
    """Eight lifecycle stages per version from the change log, in event-log form."""
    v = "model_ver_sid"
    chosen = ids.select(v).distinct()

    def mine(df: DataFrame) -> DataFrame:
        return df.join(chosen, v, "left_semi")

    prom = mine(latest_link(table, "model_ver_prom", v, "model_ver_prom_sid", F.col("model_ver_prom_stts_name") == EXPLOIT_PERMITTED))
    it = prom.join(latest_link(table, "valid_it", "model_ver_prom_sid", "valid_it_sid"), "model_ver_prom_sid").select(v, "valid_it_sid")
    implm = prom.join(latest_link(table, "model_ver_prom_x_prom_implm", "model_ver_prom_sid", "prom_implm_sid"), "model_ver_prom_sid").select(v, "prom_implm_sid")
    prevalid = mine(table("model_ver")).groupBy(v).agg(
        F.min("model_ver_prevalid_dttm").alias("start_dt"), F.max("model_ver_prevalid_dttm").alias("end_dt")
    ).filter("start_dt is not null").select(v, F.lit(STAGES["prevalidation"]).alias("stage"), "start_dt", "end_dt")

    def stage(links: DataFrame, entity: str, params: Sequence[str], name: str) -> DataFrame:
        return change_stage(links, entity, log, params, STAGES[name])

    return union_named(
        stage(mine(latest_link(table, "model_ver_x_busn_task", v, "busn_task_sid")), "busn_task_sid", ["BUSINESS_TASK_STATUS"], "business"),
        stage(chosen.withColumn("entity_sid", F.col(v)), "entity_sid", ["MODEL_VERSION_STATUS"], "development"),
        prevalid,
        stage(mine(latest_link(table, "valid", v, "valid_sid")), "valid_sid", ["VALIDATION_STATUS"], "validation"),
        stage(mine(latest_link(table, "model_ver_x_montrg_auto", v, "montrg_auto_sid")), "montrg_auto_sid", ["MONITORING_STATUS"], "auto_monitoring"),
        stage(prom, "model_ver_prom_sid", ["MODEL_PROM_VERSION_STATUS"], "prom"),
        stage(it, "valid_it_sid", ["IT_VALIDATION_STATUS"], "it_validation"),
        stage(implm, "prom_implm_sid", ["IMPLEMENTATION_STATUS", "IMPLEMENTATION_PILOT_CRITERIA"], "implementation"),
    )


def bounds(stages: DataFrame) -> DataFrame:
    return stages.groupBy("model_ver_sid").agg(F.min("start_dt").alias("start_dt"), F.max("end_dt").alias("end_dt"))


def operational_perimeter(table: Table, active: Sequence[str], categories: Sequence[str] = ("A", "B", "C", "D")) -> DataFrame:
    """Newest version of each model with an active production or pilot implementation."""
    implms = []
    for kind in ("prom", "pilot"):
        i = f"{kind}_implm"
        live = table(i).filter(F.upper(F.trim(f"{i}_stts_name")).isin(*active)).select(f"{i}_sid")
        implms.append(table(f"model_ver_prom_x_{i}").join(live, f"{i}_sid", "left_semi").select("model_ver_prom_sid"))
    proms = implms[0].union(implms[1]).distinct()
    versions = table("model_ver_prom").join(proms, "model_ver_prom_sid", "left_semi").select("model_ver_sid").distinct()
    significance = F.upper(F.trim("model_ver_signfcnt_ctgry_code"))
    pool = table("model_ver").join(versions, "model_ver_sid", "left_semi").filter(
        F.col("model_sid").isNotNull() & significance.isin(*categories))
    order = [F.col("model_ver_signfcnt_ctgry_dttm").desc_nulls_last(), F.col("model_ver_crtn_dttm").desc_nulls_last(), F.col("model_ver_sid").desc()]
    return take_latest(pool, ["model_sid"], order).select("model_sid", "model_ver_sid", significance.alias("significance"))


def stage_span(df: DataFrame, stage: str, start: str | Column, end: str | Column | None, as_of: str) -> DataFrame:
    """Stage from fact dates: open ends are capped and an inverted end is moved to the start."""
    begin = as_col(start).cast("timestamp")
    finish = begin if end is None else F.greatest(cap_open_end(end, as_of), begin)
    return df.select("model_ver_sid", begin.alias("s"), finish.alias("e")).filter("s is not null").groupBy("model_ver_sid").agg(
        F.min("s").alias("start_dt"), F.max("e").alias("end_dt")).select("model_ver_sid", F.lit(stage).alias("stage"), "start_dt", "end_dt")


def fact_stages(ids: DataFrame, table: Table, as_of: str) -> DataFrame:
    """The eight stages from recorded fact dates."""
    v = ids.select("model_ver_sid").distinct()

    def linked(name: str, on: str = "model_ver_sid") -> DataFrame:
        return table(name).join(v, on, "left_semi")

    versions, prom = linked("model_ver"), linked("model_ver_prom")
    busn = linked("model_ver_x_busn_task").select("model_ver_sid", "busn_task_sid").join(table("busn_task").drop("start_dt", "end_dt"), "busn_task_sid")
    auto = linked("model_ver_x_montrg_auto").select("model_ver_sid", "montrg_auto_sid").join(table("montrg_auto").drop("start_dt", "end_dt"), "montrg_auto_sid")
    proms = prom.select("model_ver_sid", "model_ver_prom_sid")
    it = proms.join(table("valid_it").drop("start_dt", "end_dt"), "model_ver_prom_sid")
    implm = []
    for kind in ("prom", "pilot"):
        i = f"{kind}_implm"
        facts = table(i).select(f"{i}_sid", F.col(f"{i}_start_fact_dttm").alias("s"), F.col(f"{i}_end_fact_dttm").alias("f"))
        implm.append(proms.join(table(f"model_ver_prom_x_{i}").select("model_ver_prom_sid", f"{i}_sid"), "model_ver_prom_sid").join(facts, f"{i}_sid").select("model_ver_sid", "s", "f"))
    parts = [
        stage_span(busn, STAGES["business"], F.coalesce("busn_task_start_dttm", "busn_task_crtn_dttm"), "busn_task_end_dttm", as_of),
        stage_span(versions, STAGES["development"], "model_ver_dev_start_fact_dttm", "model_ver_dev_end_fact_dttm", as_of),
        stage_span(versions, STAGES["prevalidation"], "model_ver_prevalid_dttm", None, as_of),
        stage_span(linked("valid"), STAGES["validation"], "valid_start_fact_dttm", "valid_end_fact_dttm", as_of),
        stage_span(auto, STAGES["auto_monitoring"], "montrg_auto_start_dttm", "montrg_auto_end_dttm", as_of),
        stage_span(prom, STAGES["prom"], "model_ver_prom_crtn_dttm", "model_ver_prom_distr_end_dttm", as_of),
        stage_span(it, STAGES["it_validation"], "valid_it_start_dttm", "valid_it_end_dttm", as_of),
        stage_span(implm[0].unionByName(implm[1]), STAGES["implementation"], "s", "f", as_of),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
