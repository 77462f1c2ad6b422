"""Hand-made rows for the semantic traps: text nulls, dates, tombstones, ties, scopes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from modelwarden.functions import dates, hashing
from modelwarden.functions import predicates as p
from modelwarden.operators import changelog, drift, evaluate, state
from modelwarden.plans import engine
from modelwarden.plans.spec import Control
from modelwarden.sources import contract

D = dt.date


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def flags(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_text_nulls(spark):
    df = column(spark, [None, "", " ", "null", "None", "-", "нет", "[]", '[null,""]', "$not_applicable$", "x "])
    assert flags(df, p.blank("v")) == [True] * 5 + [False] * 6
    assert flags(df, p.artifact_missing("v")) == [True] * 7 + [False, False, True, False]
    assert flags(df, p.filled("v")) == [False] * 6 + [True, False, False, True, True]
    assert flags(df, p.required("v")) == [False] * 6 + [True, False, False, False, True]


def test_booleans_are_never_null(spark):
    df = column(spark, ["true", "1", "да", "YES", "y", "false", "0", None, "maybe"])
    assert flags(df, p.truth("v")) == [True] * 5 + [False] * 4
    assert flags(df, p.falsehood("v")) == [False] * 5 + [True, True, False, False]
    assert None not in flags(df, ~p.truth("v"))


def test_dates(spark):
    df = column(spark, ["31.12.2024 9:05:00", "2024-12-31", "2024-12-31 10:00:00.123456", "bad"])
    assert [v is not None for v in flags(df, dates.parse_ts("v"))] == [True, True, True, False]
    with pytest.raises(ValueError):
        dates.parse_ts_strict(df, ["v"])
    days = column(spark, ["1901-01-01", "2099-12-31", "1999-12-31", "2000-01-01", "2090-01-01", None])
    assert flags(days, dates.real_date(F.col("v").cast("date"))) == [False, False, False, True, False, False]
    ends = column(spark, ["9999-12-31", None, "2020-01-01"])
    capped = [str(v) for v in flags(ends, dates.cap_open_end("v", "2024-06-30"))]
    assert capped == ["2024-06-30 23:59:59", "2024-06-30 23:59:59", "2020-01-01 00:00:00"]


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),)], "d date")      # a Monday
    assert dates.expand_datetime(df, ["d"], ["dayofweek"]).first()[0] == 0.0


def test_uuid_list_accepts_spaces(spark):
    u = "0a1b2c3d-0000-4000-8000-000000000001"
    assert flags(column(spark, [u, f"{u} , {u}", f"{u},x"]), p.uuid_list("v")) == [True, True, False]


SCD = "k string, start_dt date, end_dt date, ctl_action string, v string"


def scd(spark, *rows):
    return spark.createDataFrame([(k, s, e or D(9999, 12, 31), a, v) for k, s, e, a, v in rows], SCD)


def test_tombstone_before_and_after(spark):
    df = scd(spark, ("k1", D(2024, 1, 1), None, "I", "a"), ("k1", D(2024, 1, 2), None, "D", None))
    assert state.current_slice(df, ["k"], "2024-02-01").collect() == []
    assert [r.v for r in state.current_slice(df, ["k"], "2024-02-01", "before").collect()] == ["a"]


def test_bounds_are_inclusive(spark):
    day = D(2024, 5, 5)
    df = scd(spark, ("k", day, day, "I", "a"))
    assert state.current_slice(df, ["k"], "2024-05-05").count() == 1
    assert state.current_slice(df, ["k"], "2024-05-06").count() == 0


def test_ties(spark):
    same = scd(spark, ("k", D(2024, 1, 1), None, "I", "a"), ("k", D(2024, 1, 1), None, "I", "a"))
    assert state.read_state(same, ["k"], ["v"], "2024-02-01").count() == 1
    differ = scd(spark, ("k", D(2024, 1, 1), None, "I", "a"), ("k", D(2024, 1, 1), None, "I", "b"))
    with pytest.raises(Exception, match="ambiguous"):
        state.read_state(differ, ["k"], ["v"], "2024-02-01").count()
    assert sorted(r.v for r in state.read_state(differ, ["k"], ["v"], "2024-02-01", check=False).collect()) == ["a", "b"]
    with pytest.raises(Exception, match="empty mandatory key"):
        state.read_state(scd(spark, ("", D(2024, 1, 1), None, "I", "a")), ["k"], ["v"], "2024-02-01").count()
    candidates = state.state_candidates(differ, ["k"], ["v"], "2024-02-01")
    assert state.ambiguous_keys(candidates, ["k"]).first().states == 2


def test_event_state_keeps_closed_rows(spark):
    df = scd(spark, ("k", D(2024, 1, 1), D(2024, 1, 5), "I", "a"))
    assert state.read_state(df, ["k"], ["v"], "2024-02-01").count() == 0
    assert state.read_state(df, ["k"], ["v"], "2024-02-01", current=False).count() == 1


def test_closed_newest_version_is_not_replaced(spark):
    rows = [("m", "v1", "ACTIVE", dt.datetime(2024, 1, 1), "true"), ("m", "v2", "ARCHIVED", dt.datetime(2024, 2, 1), "true")]
    v = spark.createDataFrame(rows, "model_sid string, model_ver_sid string, model_ver_stts_name string, model_ver_crtn_dttm timestamp, model_ver_prom_expl_flag string")
    assert state.select_versions(v, "2024-06-30", "latest_created", "ARCHIV").count() == 0
    assert [r.model_ver_sid for r in state.select_versions(v, "2024-06-30", "latest_production", "ARCHIV").collect()] == ["v1"]
    with pytest.raises(ValueError):
        state.select_versions(v, "2024-01-15", "latest_created", "ARCHIV")      # a future date


def test_certainty_is_null_on_ties_and_undated(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", 1, t), ("a", 2, t), ("b", 3, t), ("b", 4, None), ("c", 5, t)], "k string, i int, m timestamp")
    out = state.latest_with_certainty(df, "k", "m", F.col("m").isNotNull(), "f")
    assert {r.i: r.f for r in out.collect()} == {1: None, 2: None, 3: None, 4: None, 5: True}


def rule(i, applies, issue="v = 'bad'"):
    one = F.lit("x")
    return Control(i, f"rule {i}", "d", "HIGH", "rows", F.expr(applies), F.expr(issue), ("one", one), ("two", one), "issue", "nothing to assess",
                   entity_sid="k", version="k")


def test_empty_scope_is_not_assessable(spark):
    base = {"rows": spark.createDataFrame([("k1", "bad"), ("k2", "ok"), (None, "bad")], "k string, v string")}
    rules = [rule(1, "true"), rule(2, "v = 'absent'")]
    rows = {r.query_id: r for r in engine.summary(spark, base, rules, "2024-01-01").collect()}
    assert (rows[1].numerator, rows[1].denominator, rows[1].control_status) == (2, 3, "ASSESSABLE")
    assert (rows[2].numerator, rows[2].denominator, rows[2].metric_value) == (None, 0, None)
    assert rows[2].control_status == "NOT_ASSESSABLE" and rows[2].status_reason == "nothing to assess"
    assert [r.model_ver_sid for r in engine.detail(base, rules).collect()] == ["k1"]     # unknown versions stay out


def changes(spark, values):
    rows = [("e", "p", dt.datetime(2024, 1, 1 + i // 2, i), str(i), v, "u") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "entity_sid string, parameter_name string, change_dttm timestamp, change_sid string, new_value string, user_key string")


def test_reversal(spark):
    assert changelog.reversals(changes(spark, "aba")).count() == 1
    assert changelog.reversals(changes(spark, "aaa")).count() == 0
    assert changelog.reversals(changes(spark, "abaab")).count() == 1


def test_contract(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert contract.apply_contract(df, ["a", "B"]).columns == ["a", "b"]
    with pytest.raises(ValueError, match="missing"):
        contract.apply_contract(df, ["c"])
    assert contract.select_existing(df, ["z"]).count() == 0


def test_hash_key_cannot_be_forged(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "__NULL__x")], "x string, y string")
    assert df.select(hashing.digest(["x", "y"], 1)).distinct().count() == 4


def test_one_class_and_equal_scores(spark):
    rows = [("one", 1, 0.3, 1.0), ("one", 1, 0.6, 1.0), ("flat", 1, 0.5, 2.0), ("flat", 0, 0.5, 3.0)]
    df = spark.createDataFrame(rows, "candidate string, y int, score double, weight double")
    got = {r.candidate: r for r in evaluate.metrics(df, ["candidate"]).collect()}
    assert got["one"].auc is None and got["one"].average_precision is None
    assert got["flat"].auc == 0.5


def test_psi_of_equal_parts_is_zero(spark):
    rows = [(r, float(i % 17), 1.0) for r in ("train", "valid") for i in range(170)]
    df = spark.createDataFrame(rows, "role string, a double, b double")
    assert {r.feature: round(r.psi_valid, 9) for r in drift.psi_numeric(df, "role", ["a", "b"], "train", ["valid"]).collect()} == {"a": 0.0, "b": 0.0}
