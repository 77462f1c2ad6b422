"""Reads the small star-schema test tables and derives the logical registry from them.

The derivation is written once as column text per table in :func:`layout`; a ``Dialect`` fills
in the few functions whose spelling differs between SQL engines, so that an independent engine
can build the same registry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import compilable

AS_OF = "2008-06-30"
SHIFT_DAYS = 2600        # order dates 1995-2001 become 2002-2008
LOG_SHIFT_DAYS = 5900    # event times of 2024 become late 2007


class Dialect:
    """Spellings of Spark SQL."""

    def num(self, h: str, slot: int) -> str:
        """Three hex digits of a digest as an integer in [0, 4096), cut from a 60-bit half."""
        return f"cast(shiftright({h}n{slot // 5}, {48 - 12 * (slot % 5)}) & 4095 as int)"

    def half(self, h: str, part: int) -> str:
        return f"cast(conv(substr({h}, {1 + 15 * part}, 15), 16, 10) as bigint)"

    def day(self, d: str, n: str) -> str:
        return f"date_add({d}, cast({n} as int))"

    def pick(self, items: list[str], idx: str) -> str:
        values = ", ".join("cast(null as string)" if i is None else "'" + i.replace("\\", "\\\\").replace("'", "\\'") + "'" for i in items)
        return f"element_at(array({values}), cast(({idx}) % {len(items)} + 1 as int))"

    def stamp(self, d: str) -> str:
        return f"cast({d} as timestamp)"

    def moved(self, ts: str, days: int) -> str:
        return f"cast({ts} - interval {days} days as timestamp)"


class DuckDialect(Dialect):
    """The same functions as DuckDB spells them, for checks by another engine."""

    def num(self, h, slot):
        return f"cast((({h}n{slot // 5} >> {48 - 12 * (slot % 5)}) & 4095) as integer)"

    def half(self, h, part):
        return f"cast(('0x' || substr({h}, {1 + 15 * part}, 15)) as bigint)"

    def day(self, d, n):
        return f"({d} + cast({n} as integer))"

    def pick(self, items, idx):
        values = ", ".join("null" if i is None else "'" + i.replace("'", "''") + "'" for i in items)
        return f"([{values}])[cast(({idx}) % {len(items)} + 1 as integer)]"

    def moved(self, ts, days):
        return f"cast({ts} - interval '{days}' day as timestamp)"


@dataclass
class Table:
    """Derived table: base table, digest key, columns, an optional list to repeat rows over."""

    base: str
    key: str
    cols: dict[str, str]
    where: str | None = None
    repeat: int = 0
    keys: tuple[str, ...] = field(default_factory=tuple)


STATUSES = [
    "MODEL_VERSION_BACKLOG", "MODEL_VERSION_DEVELOPMENT", "MODEL_VERSION_TRAIN_VALIDATION",
    "MODEL_VERSION_VERIFICATION", "MODEL_VERSION_AWAITING_VALIDATION", "MODEL_VERSION_DECISION_MAKING",
    "MODEL_VERSION_PILOTING_PERMITTED", "MODEL_VERSION_EXPLOIT_PERMITTED", "MODEL_VERSION_ARCHIVED",
    "MODEL_VERSION_DEVELOPMENT", "MODEL_VERSION_EXPLOIT_PERMITTED", None,
]
UUID = "'0a1b2c3d-0000-4000-8000-' || substr({h}, 1, 12)"
TRAPS = [
    None, "", " ", "null", "None", "-", "нет", "n/a", "NA", "$not_applicable$", "отсутствует", "[]",
    '[null,""]', "[ , ]", "{}", "nan", "not applicable", "не применимо", "true", "1", "Да", "YES", "y",
    "false", "0", "no", "maybe", "A", " c ", "F", "12.5", "1e3", " 7 ", "abc",
    "https://host.example/repo.git", "/data/set/part", "C:\\data\\x", "\\\\srv\\share\\x", "risk.mart_table",
    "0a1b2c3d-0000-4000-8000-000000000001",
    "0a1b2c3d-0000-4000-8000-000000000001 , 0a1b2c3d-0000-4000-8000-000000000002",
    "two   spaces here", "red", "Bitbucket ссылка", "\u00a0none\u00a0",
]


def layout(d: Dialect) -> dict[str, Table]:
    h = {i: f"h{i}" for i in (1, 2, 3)}

    def n(k: int, slot: int) -> str:
        return d.num(h[k], slot)

    def hide(value: str, k: int, slot: int, share: int = 400, text: str = "null") -> str:
        """The value, replaced by a gap for about share/4096 of the rows."""
        gap_ = "cast(null as string)" if text == "null" else f"'{text}'"
        return f"case when {n(k, slot)} < {share} then {gap_} else {value} end"

    def maybe_ts(day: str, k: int, slot: int, share: int = 500) -> str:
        """A moment, missing or a far stand-in date for some rows."""
        return (
            f"case when {n(k, slot)} < {share} then cast(null as timestamp) "
            f"when {n(k, slot)} < {share + 60} then timestamp '2999-01-01 00:00:00' else {d.stamp(day)} end"
        )

    def meta(start: str, end: str = "date '9999-12-31'", action: str | None = None, k: int = 3, slot: int = 9) -> dict[str, str]:
        return {
            "start_dt": start, "end_dt": end,
            "ctl_action": action or f"case when {n(k, slot)} < 80 then 'D' when {n(k, slot)} < 900 then null else 'U' end",
            "ctl_datechange": d.stamp(start),
        }

    odate = d.day("cast(o_orderdate as date)", str(SHIFT_DAYS))
    sdate = d.day("cast(l_shipdate as date)", str(SHIFT_DAYS))
    okey = "cast(o_orderkey as string)"
    ckey = "cast(c_custkey as string)"
    lkey = "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"
    ckkey = "cast(o_custkey as string)"
    flag = ["true", "false", "1", "0", "да", "нет", None, "maybe"]
    dept = ["Retail  Risk", "Corporate", "Markets", "Operations", "null", None, "Treasury"]
    cat = "substr('ABCDE', cast(substr(o_orderpriority, 1, 1) as integer), 1)"
    vstart = f"case when v = 1 then {odate} else {d.day(odate, f'41 + {d.num('h0', 0)} % 60')} end"
    results = ["GREEN", "YELLOW", "RED"]
    out: dict[str, Table] = {}

    out["model"] = Table("customer", ckey, {
        "model_sid": ckey,
        "model_name": hide("c_name", 1, 0, 200),
        "model_code": hide("'M-' || cast(c_nationkey as string) || '-' || cast(c_custkey % 400 as string)", 1, 1, 200),
        "model_type_name": d.pick(["BINARY", "REGRESSION", "CLUSTERING", None, "LLM"], n(1, 2)),
        "model_subtype_name": "c_mktsegment",
        "model_ml_task_name": d.pick(["SCORING", "FORECAST", None], n(1, 3)),
        "model_rsk_flag": d.pick(flag, n(1, 4)),
        "model_rsk_type_name": d.pick(["CREDIT", "MARKET", None], n(1, 5)),
        "model_rsk_sgmnt_name": "c_mktsegment",
        "model_stts_name": d.pick(["ACTIVE", "CLOSED"], n(1, 6)),
        "model_other_docs_sid": d.pick([None, "$not_applicable$", "doc-1", "[]"], n(1, 7)),
        "model_conf_ctgry_name": d.pick(["K1", "K2", None], n(1, 8)),
        "model_sel_secret_flag": d.pick(flag, n(1, 9)),
        **meta("date '2001-01-01'"),
    }, keys=("model_sid",))

    out["model_ver"] = Table("orders", okey, {
        "model_ver_sid": okey,
        "model_sid": hide(ckkey, 1, 0, 20),
        "model_ver_num": hide("cast(o_orderkey % 9 + 1 as string)", 1, 1, 100),
        "model_ver_name": hide("'version ' || cast(o_orderkey as string)", 1, 2, 150, "-"),
        "model_ver_stts_name": d.pick(STATUSES, n(1, 3)),
        "model_ver_signfcnt_ctgry_code": hide(cat, 1, 4, 300),
        "model_ver_signfcnt_lvl_name": "o_orderpriority",
        "model_ver_signfcnt_ctgry_dttm": maybe_ts(d.day(odate, "30"), 1, 5),
        "model_ver_owner_block_name": d.pick(["Block 1", "Block 2", None], n(1, 6)),
        "model_ver_owner_dprtmt_name": d.pick(dept, n(1, 7)),
        "model_ver_owner_cont_name": hide("'person ' || cast(o_custkey % 50 as string)", 1, 8),
        "model_ver_dev_block_name": d.pick(["Block 1", "Block 3", ""], n(1, 9)),
        "model_ver_dev_dprtmt_name": d.pick(dept, n(2, 0)),
        "model_ver_dev_dprtmt_cont_name": hide("'team ' || cast(o_custkey % 20 as string)", 2, 1),
        "model_ver_method_name": hide("'boosting'", 2, 2, 500, "none"),
        "model_ver_data_type_name": d.pick(["TABLE", "TEXT", "", None], n(2, 3)),
        "model_ver_tgt_txt": hide("'default in 12 months'", 2, 4, 900),
        "model_ver_repstry_link_txt": d.pick(["https://git.example/repo", "-", None, "нет", "https://git.example/b"], n(2, 5)),
        "model_ver_implm_repstry_link_txt": hide("'https://git.example/prod'", 2, 5, 2600),
        "model_ver_repstry_commit_sid": hide("substr(h2, 1, 8)", 2, 6, 1200, "n/a"),
        "model_ver_repstry_non_link_reason_name": d.pick([None, None, "vendor"], n(2, 6)),
        "model_ver_repstry_non_link_reason_cmnt_txt": d.pick([None, None, None, "bought model"], n(2, 7)),
        "model_ver_dev_report_sid": f"case when {n(2, 7)} < 600 then null when {n(2, 7)} < 900 then 'report 7' "
                                    f"when {n(2, 7)} < 1500 then {UUID.format(h='h1')} || ' , ' || {UUID.format(h='h2')} "
                                    f"else {UUID.format(h='h1')} end",
        "model_ver_other_docs_sid": d.pick([None, "n/a", "doc-2"], n(2, 8)),
        "model_ver_dev_start_plan_dttm": maybe_ts(odate, 2, 8),
        "model_ver_dev_start_fact_dttm": maybe_ts(d.day(odate, f"{n(2, 9)} % 40 - 15"), 2, 9),
        "model_ver_dev_end_plan_dttm": maybe_ts(d.day(odate, f"{n(3, 0)} % 200 - 10"), 3, 0),
        "model_ver_dev_end_fact_dttm": maybe_ts(d.day(odate, f"{n(3, 1)} % 260 - 10"), 3, 1, 1200),
        "model_ver_prevalid_dttm": maybe_ts(d.day(odate, "90"), 3, 2, 2000),
        "model_ver_prevalid_flag": d.pick(flag, n(3, 2)),
        "model_ver_prevalid_rslt_name": d.pick(["POSITIVE", None, "NEGATIVE", ""], n(3, 3)),
        "model_ver_llm_flag": d.pick(flag, n(3, 3)),
        "model_ver_llm_descr_txt": hide("'summaries'", 3, 4, 2000),
        "model_ver_proj_feature_flag": d.pick(flag, n(3, 4)),
        "model_ver_proj_feature_sid": hide("'fs-' || cast(o_orderkey as string)", 3, 5, 1800),
        "model_ver_dev_src_name": d.pick(["IN_HOUSE", "VENDOR", None], n(3, 5)),
        "model_ver_dev_sys_name": d.pick(["SYS1", "SYS2"], n(3, 6)),
        "model_ver_data_mart_link_txt": d.pick(["risk.mart_a", "/mart/b/c", None], n(3, 6)),
        "model_ver_montrg_auto_flag": d.pick(flag, n(3, 7)),
        "model_ver_montrg_auto_exclude_reason_array": d.pick(['["small"]', "[]", None, '[null,""]'], n(3, 7)),
        "model_ver_montrg_last_sid": d.pick(["a", "n", None], n(3, 8)) + f" || {ckkey}",
        "model_ver_montrg_last_rslt_name": d.pick(["GREEN", None, "отсутствует", "YELLOW", None], n(3, 8)),
        "model_ver_busn_proc_code": d.pick(["BP-1", None, "BP-2", "n/a"], n(1, 9)),
        "model_ver_crtn_dttm": maybe_ts(d.day(odate, "-20"), 1, 8, 60),
        "model_ver_signfcnt_ctgry_descr_txt": hide("'because of ' || o_orderpriority", 3, 9, 900),
        "model_ver_prevalid_report_file_sid": hide("'pf-' || cast(o_orderkey as string)", 1, 6, 1500),
        "model_ver_prevalid_report_link_sid": hide("'pl-' || cast(o_orderkey as string)", 1, 7, 2500),
        "model_ver_prevalid_report_link_txt": d.pick(["https://docs.example/pre", None, "-"], n(2, 1)),
        **meta(vstart, f"case when v = 1 and {d.num('h0', 1)} < 3000 then {d.day(odate, f'40 + {d.num('h0', 0)} % 60')} else date '9999-12-31' end"),
    }, where=f"v = 1 or {d.num('h0', 1)} < 3000", repeat=2, keys=("model_ver_sid",))

    out["model_ver_anlt_dtl"] = Table("orders", "'an' || " + okey, {
        "model_ver_sid": okey,
        "model_ver_prom_sid": f"case when {n(1, 0)} < 400 then null else 'p' || {okey} end",
        "model_ver_stts_name": d.pick(STATUSES, n(1, 1)),
        "model_stts_name": d.pick(["ACTIVE", "CLOSED", None], n(1, 2)),
        "model_ver_prom_expl_flag": d.pick(["true", "false", "1", "да", None], n(1, 3)),
        "model_ver_not_valid_flag": d.pick(["false", "false", "true", None], n(1, 4)),
        "model_ver_busn_proc_code": d.pick(["BP-1", "n/a", None, "[]", "BP-3"], n(1, 5)),
        "model_ver_prom_actual_implm_first_dttm": maybe_ts(d.day(odate, "200"), 1, 6),
        "model_ver_prom_actual_implm_last_dttm": maybe_ts(d.day(odate, "260"), 1, 7),
        "model_ver_prom_implm_first_dttm": maybe_ts(d.day(odate, "190"), 1, 8),
        "model_ver_prom_actual_expl_output_dttm": maybe_ts(d.day(odate, "700"), 1, 9, 3000),
        "model_ver_prom_expl_output_dttm": maybe_ts(d.day(odate, "710"), 2, 0, 3000),
        "model_ver_prom_crtn_dttm": maybe_ts(d.day(odate, "150"), 2, 1),
        "model_ver_signfcnt_ctgry_code": hide(f"case when {n(2, 3)} < 400 then 'B' else {cat} end", 2, 2),
        "model_ver_signfcnt_lvl_name": hide("o_orderpriority", 2, 4),
        "model_ver_valid_last_rslt_name": d.pick([None, "GREEN", "отсутствует", None], n(2, 5)),
        "model_ver_employer_block_name": d.pick(["Block 9", None], n(2, 6)),
        "model_ver_employer_dprtmt_name": d.pick(["Sales", "Sales", ""], n(2, 7)),
        "model_ver_risk_sgmnt_name": d.pick(["RETAIL", "n/a", None], n(2, 8)),
        **meta(odate),
    }, keys=("model_ver_sid", "model_ver_prom_sid"))

    out["model_ver_prom"] = Table("orders", "'pr' || " + okey, {
        "model_ver_prom_sid": f"'p' || {okey}",
        "model_ver_sid": okey,
        "model_ver_prom_stts_name": d.pick(
            ["MODEL_PROM_VERSION_AWAITING_ARTIFACTS", "MODEL_PROM_VERSION_READY_FOR_UAT", "MODEL_PROM_VERSION_EXPLOIT_PERMITTED",
             "MODEL_PROM_VERSION_CANCELED", "MODEL_PROM_VERSION_PILOTING_PERMITTED", None], n(1, 0)),
        "model_ver_prom_repstry_commit_link_txt": d.pick(["https://git.example/p/commit", "-", None], n(1, 1)),
        "model_ver_prom_valid_it_rslt_qgm_flag": d.pick(flag, n(1, 2)),
        "model_ver_prom_implm_flag": d.pick(["true", "", None, "false"], n(1, 3)),
        "model_ver_prom_instr_name": d.pick(["BATCH", "ONLINE"], n(1, 4)),
        "model_ver_prom_sys_name": d.pick(["SYS1", "SYS9"], n(1, 5)),
        "model_ver_prom_crtn_dttm": maybe_ts(d.day(odate, "150"), 1, 6),
        "model_ver_prom_distr_end_dttm": maybe_ts(d.day(odate, "140 + " + n(1, 8) + " % 60"), 1, 8),
        "model_ver_prom_dev_block_name": d.pick(["Block 1", None], n(1, 7)),
        "model_ver_prom_dev_dprtmt_name": d.pick(dept, n(1, 9)),
        **meta(d.day(odate, "100")),
    }, where=f"{d.num('h1', 9)} < 3600", keys=("model_ver_prom_sid",))

    out["valid"] = Table("lineitem", lkey + " || '/' || cast(l_partkey as string) || '/' || cast(l_suppkey as string)", {
        "valid_sid": lkey,
        "model_ver_sid": hide("cast(l_orderkey as string)", 1, 0, 40),
        "valid_stts_name": d.pick(["VALIDATION_DONE", "VALIDATION_DONE_NEGATIVE", "VALIDATION_BACKLOG", "VALIDATION_PROCESS",
                                   "VALIDATION_CANCELED", "VALIDATION_RESULTS_APPROVE", None], n(1, 1)),
        "valid_rslt_name": hide("case l_returnflag when 'R' then 'RED' when 'A' then 'YELLOW' else 'GREEN' end", 1, 2, 500),
        "valid_prblm_name": d.pick([None, "data quality", "low  power", ""], n(1, 3)),
        "valid_dprtmt_name": d.pick(["Validation A", "Validation B", None], n(1, 4)),
        "valid_type_name": d.pick(["MANUAL", "AUTO", None], n(1, 5)),
        "valid_dev_return_reason_txt": "case when l_linestatus = 'O' then " + d.pick(
            [None, "Не предоставлены данные", "Не предоставлен доступ к данным",
             "Не предоставлена информация для формирования валидационных выборок", "прочее", None, ""], n(1, 6)) + " end",
        "valid_crtn_dttm": maybe_ts(d.day(sdate, "-40"), 1, 7, 100),
        "valid_start_fact_dttm": maybe_ts(d.day(sdate, f"{n(1, 8)} % 30 - 30"), 1, 8),
        "valid_end_fact_dttm": maybe_ts(sdate, 1, 9, 700),
        "valid_freq_start_plan_dttm": maybe_ts(d.day(sdate, "365"), 2, 0),
        "valid_report_sid": d.pick([None, "rep-1", "-", "rep-2"], n(2, 1)),
        "valid_not_sample_data_flag": d.pick(flag, n(2, 2)),
        "valid_src_not_table_flag": d.pick(flag, n(2, 3)),
        "valid_alt_flag": d.pick(flag, n(2, 4)),
        "valid_alt_metric_name": d.pick(["GINI", None], n(2, 5)),
        "valid_alt_metric_val": d.pick(["0.4", "", "0.5"], n(2, 6)),
        "valid_red_zone_owner_aprvl_rsk_flag": d.pick(flag, n(2, 7)),
        "valid_red_zone_comt_rsk_decsn_sid": d.pick(["dec-1", None], n(2, 8)),
        "valid_red_zone_comt_rsk_decsn_link_txt": d.pick(["https://d.example", "нет", "https://e.example"], n(2, 9)),
        "valid_agent_usg_flag": d.pick(flag, n(3, 0)),
        "valid_agent_test_quality_corr_pct": d.pick(["0.9", None], n(3, 1)),
        "valid_agent_test_quality_reuse_pct": d.pick(["0.5", None, None], n(3, 2)),
        "valid_agent_test_quantity_reuse_pct": d.pick(["0.3", None], n(3, 3)),
        "valid_agent_non_usg_reason_name": d.pick(["cost", "none"], n(3, 4)),
        "valid_prevalid_reuse_lvl_name": d.pick(["FULL", "PART", None], n(3, 5)),
        "valid_prevalid_reuse_lvl_reason_array": d.pick(['["a"]', None, '["b"]'], n(3, 6)),
        **meta(d.day(sdate, f"{n(3, 8)} % 400 - 600")),
        "ctl_loading": "cast(l_partkey * 1000 + l_suppkey as bigint)",
    }, keys=("valid_sid",))

    out["sample_data"] = Table("lineitem", "'s' || " + lkey + " || '/' || cast(l_partkey as string) || '/' || cast(l_suppkey as string)", {
        "sample_data_sid": f"'s' || {lkey}",
        "model_ver_sid": hide("cast(l_orderkey as string)", 1, 0, 1200),
        "valid_sid": hide(lkey, 1, 1, 800),
        "montrg_auto_rslt_sid": hide("'ar' || cast(l_partkey as string)", 1, 2, 1200),
        "montrg_manual_rslt_sid": hide("'mr' || cast(l_suppkey as string)", 1, 3, 2000),
        "sample_data_prop_array": d.pick(['["TRAIN"]', '["OUT_OF_TIME"]', '["OUT-OF-TIME"]', None, '["ВНЕВРЕМЕННАЯ"]', "[]"], n(1, 4)),
        "sample_data_type_name": d.pick(["Тестовая", "Валидационная", "Обучающая", "Мониторинг", None, "Стабильность"], n(1, 5)),
        "sample_data_stts_name": d.pick(["READY", None], n(1, 6)),
        "sample_data_not_metric_calc_flag": d.pick(flag, n(1, 7)),
        "sample_data_addtnl_info_txt": d.pick(["hdfs://lake/set/1", "risk.sample_tab", "to follow", None, "[]", "/data/s/2"], n(1, 8)),
        **meta(d.day(sdate, f"{n(2, 0)} % 400 - 600")),
        "ctl_loading": "cast(l_partkey * 1000 + l_suppkey as bigint)",
    }, keys=("sample_data_sid",))

    out["metric"] = Table("lineitem", "'m' || " + lkey + " || '/' || cast(l_partkey as string) || '/' || cast(l_suppkey as string)", {
        "metric_sid": f"'m' || {lkey}",
        "sample_data_sid": "'s' || cast(l_orderkey as string) || '-' || cast(l_linenumber % 4 + 1 as string)",
        "metric_name": d.pick(["GINI", "gini ", "KS", None, "AUC", "GINI"], n(1, 0)),
        "metric_val": f"case when {n(1, 1)} < 300 then 'n/a' when {n(1, 1)} < 700 then null "
                      f"when {n(1, 1)} < 900 then '0,5' else '0.' || cast({n(1, 1)} % 100 as string) end",
        "metric_stts_name": d.pick(["OK", None], n(1, 2)),
        **meta(d.day(sdate, f"{n(2, 0)} % 400 - 600")),
        "ctl_loading": "cast(l_partkey * 1000 + l_suppkey as bigint)",
    }, keys=("metric_sid",))

    for kind, letter, base, key in (("auto", "a", "customer", "c_custkey"), ("manual", "n", "supplier", "s_suppkey")):
        sid = f"'{letter}' || cast({key} as string)"
        m = f"montrg_{kind}"
        out[m] = Table(base, sid, {
            f"{m}_sid": sid,
            f"{m}_stts_name": d.pick(["ACTIVE", "CLOSED", "PAUSED", None], n(1, 0)),
            f"{m}_next_dttm": maybe_ts(d.day("date '2008-01-01'", f"{n(1, 1)} % 400"), 1, 1),
            f"{m}_proj_sched_stts_name": d.pick(["ACTIVE", "active", "OFF", None], n(1, 2)),
            f"{m}_proj_sched_cron_txt": d.pick(["0 0 * * *", None], n(1, 3)),
            f"{m}_proj_sched_start_dttm": maybe_ts("date '2007-01-01'", 1, 4, 1000),
            f"{m}_dprtmt_name": d.pick(["Monitoring A", None, "Monitoring B"], n(1, 5)),
            f"{m}_last_rslt_name": d.pick(["GREEN", None, "RED"], n(1, 6)),
            f"{m}_last_rslt_dttm": maybe_ts(d.day("date '2006-06-01'", f"{n(1, 7)} % 760"), 1, 7, 800),
            f"{m}_crtn_dttm": d.stamp("date '2005-01-01'"),
            f"{m}_start_dttm": maybe_ts(d.day("date '2005-01-01'", f"{n(1, 8)} % 300"), 1, 8),
            f"{m}_end_dttm": maybe_ts(d.day("date '2005-06-01'", f"{n(1, 9)} % 900"), 1, 9, 1500),
            **meta("date '2005-01-01'"),
        }, keys=(f"{m}_sid",))
        r = f"montrg_{kind}_rslt"
        pre = "ar" if kind == "auto" else "mr"
        out[r] = Table("events", f"'{pre}' || cast(event_id as string)", {
            f"{r}_sid": f"'{pre}' || cast(event_id as string)",
            f"{m}_sid": hide(f"'{letter}' || cast(user_id as string)", 1, 9, 100),
            f"{r}_name": d.pick(["GREEN", "RED", None, "отсутствует", "YELLOW"], n(1, 0)),
            f"{r}_stts_name": d.pick(["RESULT_DONE", "RESULT_COMPLETE", "PROCESS", "ЗАВЕРШЕН", None], n(1, 1)),
            f"{r}_prblm_name": d.pick([None, "drift", "none", "missing data"], n(1, 2)),
            f"{r}_metric_val": d.pick(["0.3", None, "0.4"], n(1, 3)),
            f"{r}_not_metric_main_flag": d.pick(flag, n(1, 4)),
            f"{r}_valid_not_sample_data_flag": d.pick(flag, n(1, 5)),
            f"{r}_report_sid": d.pick(["rep-9", None, "-"], n(1, 6)),
            f"{r}_crtn_dttm": d.moved("ts", LOG_SHIFT_DAYS),
            f"{r}_start_dttm": d.moved("ts", LOG_SHIFT_DAYS + 3),
            f"{r}_end_dttm": d.moved("ts", LOG_SHIFT_DAYS - 2),
            **meta(f"cast({d.moved('ts', LOG_SHIFT_DAYS)} as date)"),
        }, keys=(f"{r}_sid",))
        out[f"model_ver_x_{m}"] = Table("orders", f"'x{kind}' || " + okey, {
            "model_ver_sid": okey,
            f"{m}_sid": f"'{letter}' || {ckkey}",
            **meta(d.day(odate, "60")),
        }, where=f"{d.num('h1', 0)} < 2500", keys=("model_ver_sid", f"{m}_sid"))

    for kind in ("pilot", "prom"):
        i = f"{kind}_implm"
        out[i] = Table("orders", f"'{i}' || " + okey, {
            f"{i}_sid": f"'{kind[:2]}{kind[-1]}' || {okey}",
            f"{i}_stts_name": d.pick(["IMPLEMENTATION_EXPLOIT", "IMPLEMENTATION_DONE", "IMPLEMENTATION_PLAN", None], n(1, 0)),
            f"{i}_crtn_dttm": maybe_ts(d.day(odate, "200"), 1, 1),
            f"{i}_start_plan_dttm": maybe_ts(d.day(odate, "220"), 1, 2),
            f"{i}_start_fact_dttm": maybe_ts(d.day(odate, f"200 + {n(1, 3)} % 60"), 1, 3, 1200),
            f"{i}_end_fact_dttm": maybe_ts(d.day(odate, f"190 + {n(1, 4)} % 300"), 1, 4, 2000),
            f"{i}_type_name": d.pick(["FULL", "SHADOW"], n(1, 5)),
            **meta(d.day(odate, "200")),
        }, where=f"{d.num('h1', 8)} < 2000", keys=(f"{i}_sid",))
        out[f"model_ver_prom_x_{i}"] = Table("orders", f"'x{i}' || " + okey, {
            "model_ver_prom_sid": f"'p' || {okey}",
            f"{i}_sid": f"'{kind[:2]}{kind[-1]}' || {okey}",
            **meta(d.day(odate, "200")),
        }, keys=("model_ver_prom_sid", f"{i}_sid"))

    out["valid_it"] = Table("orders", "'vi' || " + okey, {
        "valid_it_sid": f"'vi' || {okey} || '-' || cast(v as string)",
        "model_ver_prom_sid": f"'p' || {okey}",
        "valid_it_stts_name": d.pick(["IT_DONE", "IT_PROCESS", "ЗАВЕРШЕНА", None], n(1, 0)),
        "valid_it_rslt_name": d.pick(["PASSED", "FAILED", None], n(1, 1)),
        "valid_it_dprtmt_name": d.pick(["IT A", "IT B"], n(1, 2)),
        "valid_it_crtn_dttm": maybe_ts(d.day(odate, "170 + v"), 1, 3, 100),
        "valid_it_start_dttm": maybe_ts(d.day(odate, f"170 + {n(1, 4)} % 20"), 1, 4, 1000),
        "valid_it_end_dttm": maybe_ts(d.day(odate, f"175 + {n(1, 5)} % 40"), 1, 5, 1500),
        **meta(d.day(odate, "170 + v")),
    }, where=f"{d.num('h1', 9)} < 2500", repeat=2, keys=("valid_it_sid",))

    out["busn_task"] = Table("customer", "'b' || " + ckey, {
        "busn_task_sid": f"'b' || {ckey}",
        "busn_task_name": "'task ' || c_mktsegment",
        "busn_task_claim_descr_txt": d.pick(["approve loans", None], n(1, 0)),
        "busn_task_crtn_dttm": d.stamp(d.day("date '2002-01-01'", n(1, 1) + " % 900")),
        "busn_task_start_dttm": maybe_ts(d.day("date '2002-02-01'", n(1, 2) + " % 900"), 1, 2, 1500),
        "busn_task_end_dttm": maybe_ts(d.day("date '2002-06-01'", n(1, 3) + " % 900"), 1, 3, 1000),
        "busn_task_employer_block_name": d.pick(["Block 5", None], n(1, 4)),
        "busn_task_employer_dprtmt_name": d.pick(["Retail", None, "Cards"], n(1, 5)),
        **meta("date '2002-01-01'"),
    }, keys=("busn_task_sid",))
    out["model_ver_x_busn_task"] = Table("orders", "'xb' || " + okey, {
        "model_ver_sid": okey, "busn_task_sid": f"'b' || {ckkey}", **meta(d.day(odate, "5")),
    }, keys=("model_ver_sid", "busn_task_sid"))

    out["genai"] = Table("supplier", "'g' || cast(s_suppkey as string)", {
        "genai_sid": "'g' || cast(s_suppkey as string)",
        "genai_stts_name": d.pick(["ACTIVE", "DRAFT"], n(1, 0)),
        "genai_agent_flag": d.pick(["true", "false", None], n(1, 1)),
        "genai_priority_lvl_code": d.pick(["high", " LOW", None], n(1, 2)),
        "genai_maturity_lvl_ord": d.pick(["1", "2", "3", None], n(1, 3)),
        "genai_owner_dprtmt_name": d.pick(["Retail", "", "Markets", None], n(1, 4)),
        **meta("date '2006-01-01'"),
    }, keys=("genai_sid",))
    out["genai_ver"] = Table("part", "'gv' || cast(p_partkey as string)", {
        "genai_ver_sid": "'gv' || cast(p_partkey as string)",
        "genai_sid": "'g' || cast(p_partkey % 120 as string)",
        "genai_ver_stts_name": d.pick(["GENAI_PILOT", "GENAI_EXPLOIT", "GENAI_DRAFT", "GENAI_DEVELOPMENT", "GENAI_RELEASE", None], n(1, 0)),
        "genai_ver_signfcnt_ctgry_code": d.pick(["A", "B", "C", None], n(1, 1)),
        "genai_ver_repstry_link_txt": d.pick(["https://git.example/g", None, "-"], n(1, 2)),
        "genai_ver_repstry_commit_link_txt": d.pick(["https://git.example/g/c", None, "n/a"], n(1, 3)),
        "genai_ver_distr_commit_link_txt": d.pick([None, "https://git.example/d"], n(1, 4)),
        "genai_ver_release_link_txt": d.pick(["https://rel.example", "нет"], n(1, 5)),
        "genai_ver_dev_report_sid": d.pick(["rep", None], n(1, 6)),
        "genai_ver_sample_data_knowledge_lvl_name": d.pick(["KNOWN", None, "none"], n(1, 7)),
        "genai_ver_montrg_auto_data_flag": d.pick(flag, n(1, 8)),
        "genai_ver_montrg_auto_model_flag": d.pick(flag, n(1, 9)),
        "genai_ver_montrg_auto_exclude_reason_data_array": d.pick(['["x"]', None], n(2, 0)),
        "genai_ver_montrg_auto_exclude_reason_model_array": d.pick(['["y"]', ""], n(2, 1)),
        "genai_ver_montrg_last_rslt_dttm": maybe_ts(d.day("date '2006-06-01'", n(2, 2) + " % 760"), 2, 2, 800),
        "genai_ver_metric_key_code": d.pick(["F1", None, "BLEU"], n(2, 3)),
        "genai_ver_metric_key_val": d.pick(["0.7", "", None], n(2, 4)),
        "genai_ver_metric_assmnt_auto_cmnt_txt": d.pick(["fine", "null"], n(2, 5)),
        "genai_ver_usg_days_qty": d.pick(["30", None], n(2, 6)),
        "genai_ver_usg_same_time_cnt": d.pick(["5", None, "9"], n(2, 7)),
        "genai_ver_fin_effect_plan_million_qty": d.pick(["10", "0", None, "2.5"], n(2, 8)),
        "genai_ver_fin_effect_fact_million_qty": d.pick(["9", "12", None], n(2, 9)),
        **meta("date '2006-03-01'"),
    }, keys=("genai_ver_sid",))
    out["genai_ver_sample_data"] = Table("part", "'gs' || cast(p_partkey as string)", {
        "genai_ver_sample_data_sid": "'gs' || cast(p_partkey as string)",
        "genai_ver_sid": "'gv' || cast(p_partkey * 2 as string)",
        **meta("date '2006-03-01'"),
    }, keys=("genai_ver_sample_data_sid",))
    out["genai_ver_valid"] = Table("part", "'gw' || cast(p_partkey as string)", {
        "genai_ver_valid_sid": "'gw' || cast(p_partkey as string) || '-' || cast(v as string)",
        "genai_ver_sid": "'gv' || cast(p_partkey as string)",
        "genai_ver_valid_stts_name": d.pick(["DONE", "PROCESS"], n(1, 0)),
        "genai_ver_valid_rslt_name": d.pick(["GREEN", "RED", None, "none", "YELLOW"], n(1, 1)),
        "genai_ver_valid_crtn_dttm": maybe_ts(d.day("date '2006-04-01'", n(1, 2) + " % 300"), 1, 2, 100),
        "genai_ver_valid_start_fact_dttm": maybe_ts(d.day("date '2006-05-01'", n(1, 3) + " % 300"), 1, 3),
        "genai_ver_valid_end_fact_dttm": maybe_ts(d.day("date '2006-06-01'", n(1, 4) + " % 330"), 1, 4),
        "genai_ver_valid_report_sid": d.pick(["rep", "-", None], n(1, 5)),
        "genai_ver_valid_alt_flag": d.pick(flag, n(1, 6)),
        "genai_ver_valid_alt_metric_name": d.pick(["KS", None], n(1, 7)),
        "genai_ver_valid_alt_metric_val": d.pick(["0.1", "", "0.2"], n(1, 8)),
        **meta("date '2006-04-01'"),
    }, where=f"{d.num('h1', 9)} < 3000", repeat=2, keys=("genai_ver_valid_sid",))

    etype = d.pick(["MODEL_VERSION", "MODEL_VERSION", " model_ver ", "MODEL", "BUSINESS_TASK", None], n(1, 0))
    out["ent_param_chg"] = Table("events", "'chg' || cast(event_id as string)", {
        "ent_sid": "case when " + n(1, 1) + " < 60 then null when (" + n(1, 0) + ") % 6 = 4 then 'b' || cast(user_id as string) "
                   "else cast(user_id as string) end",
        "ent_type_name": etype,
        "ent_param_chg_sid": "case event_type when 'click' then 'MODEL_VERSION_STATUS' when 'view' then 'MODEL_VERSION_IMPORTANCE_UMR' "
                             "when 'purchase' then 'MODEL_VERSION_MODEL_EFFECT' when 'signup' then 'BUSINESS_TASK_STATUS' "
                             "else 'IMPLEMENTATION_STATUS' end",
        "ent_param_chg_name": hide("'par ' || event_type", 1, 2, 80),
        "ent_param_chg_prev_val": hide("'v' || cast(" + n(1, 3) + " % 3 as string)", 1, 4, 600),
        "ent_param_chg_val": hide("'v' || cast(" + n(1, 5) + " % 3 as string)", 1, 6, 100),
        "ent_param_chg_type_code": d.pick(["upd", "INS", None], n(1, 7)),
        "ent_param_chg_usr_sid": hide("'u' || cast(user_id % 7 as string)", 1, 8, 500),
        "ent_param_chg_usr_name": hide("'User ' || cast(user_id % 7 as string)", 1, 8, 400),
        "event_sid": "cast(event_id as string)",
        "start_dttm": f"case when {n(1, 9)} < 60 then null else {d.moved('ts', LOG_SHIFT_DAYS)} end",
        "end_dttm": f"case when {n(2, 0)} < 2000 then timestamp '9999-12-31 00:00:00' "
                    f"when {n(2, 0)} < 2200 then {d.moved('ts', LOG_SHIFT_DAYS + 1)} else {d.moved('ts', LOG_SHIFT_DAYS - 5)} end",
        "ctl_action": d.pick(["I", "U", None, "U", "U", "U", "U", "U", "U", "U", "D"], n(2, 1)),
        "ctl_datechange": d.moved("ts", LOG_SHIFT_DAYS),
    })

    out["text_probe"] = Table("orders", "'t' || " + okey, {
        "row_sid": okey,
        "raw": d.pick(TRAPS, n(1, 0)),
        "date_text": d.pick(
            [None, "", "bad", "31.12.2024 9:05:00", "2024-12-31", "2024-12-31 10:00:00.123456", "2024-02-30", "1901-01-01",
             "2099-12-31", "1999-12-31", "2000-01-01", "2090-01-01", "15.06.2008 23:59:59"], n(1, 1)),
        "start_day": maybe_ts(odate, 1, 2),
        "end_day": maybe_ts(d.day(odate, n(1, 3) + " % 90 - 10"), 1, 3),
    })
    return out


BASES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


SPREAD_ABOVE_BYTES = 128 * 1024


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. A lone file of one row group is a single task, so its rows are spread
    over the cores before the derivations; an input with enough splits is read as it is."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_ABOVE_BYTES and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


class Registry:
    """Derived tables by name: ``raw`` history and ``current`` slices at the as-of day."""

    _shared: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> Registry:
        """One registry of lazy frames per session and folder."""
        key = (spark.sparkContext.applicationId, sf_dir, as_of)
        if key not in cls._shared:
            cls._shared = {key: cls(spark, sf_dir, as_of)}
        return cls._shared[key]

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._layout = layout(Dialect())
        self._made: dict[tuple[str, str], DataFrame] = {}

    def _once(self, kind: str, name: str, make) -> DataFrame:
        if (kind, name) not in self._made:
            self._made[kind, name] = make(name)
        return self._made[kind, name]

    def base(self, name: str) -> DataFrame:
        return self._once("base", name, lambda n: base_table(self.spark, self.sf_dir, n))

    def raw(self, name: str) -> DataFrame:
        return self._once("raw", name, self._derive)

    def current(self, name: str) -> DataFrame:
        from .operators.state import current_slice

        return self._once("current", name, lambda n: current_slice(self.raw(n), list(self._layout[n].keys), self.as_of))

    def kept(self, name: str, columns: Sequence[str], hold: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Some columns of a current slice, written by ``hold`` for several readers."""
        from .operators.state import kept_slice

        wanted = self.current(name).select(*columns).columns  # an unknown column is an error before anything is written
        return kept_slice(self.raw(name), list(self._layout[name].keys), self.as_of, wanted, hold)

    def _derive(self, name: str) -> DataFrame:
        t = self._layout[name]
        df = self.base(t.base)
        compilable(self.spark)
        if t.repeat:
            df = df.withColumn("v", F.explode(F.array(*[F.lit(i + 1) for i in range(t.repeat)])))
        key = t.key + (" || '#' || cast(v as string)" if t.repeat else "")
        df = df.withColumns({
            "h0": F.expr(f"md5('0:' || {t.key})"),
            **{f"h{i}": F.expr(f"md5('{i}:' || {key})") for i in (1, 2, 3)},
        })
        d = Dialect()
        df = df.withColumns({f"h{i}n{p}": F.expr(d.half(f"h{i}", p)) for i in range(4) for p in (0, 1)})
        if t.where:
            df = df.filter(t.where)
        return df.select(*[F.expr(e).alias(c) for c, e in t.cols.items()])


def duck_sql(name: str) -> str:
    """The derived history table as a DuckDB query."""
    d = DuckDialect()
    t = layout(d)[name]
    key = t.key + (" || '#' || cast(v as string)" if t.repeat else "")
    source = t.base + (f", unnest([{', '.join(str(i + 1) for i in range(t.repeat))}]) r(v)" if t.repeat else "")
    digests = f"md5('0:' || {t.key}) h0, " + ", ".join(f"md5('{i}:' || {key}) h{i}" for i in (1, 2, 3))
    cols = ", ".join(f"{e} as {c}" for c, e in t.cols.items())
    where = f" where {t.where}" if t.where else ""
    halves = ", ".join(f"{d.half(f'h{i}', p)} h{i}n{p}" for i in range(4) for p in (0, 1))
    return f"select {cols} from (select *, {halves} from (select *, {digests} from {source}) q) s{where}"


def duck_keys(name: str) -> tuple[str, ...]:
    return layout(DuckDialect())[name].keys
