"""A slice that is found by row numbers equals the one that is sorted whole."""

import pytest
from modelwarden.operators.state import current_slice, kept_slice
from pyspark.sql import functions as F

AS_OF = "2008-06-30"


@pytest.mark.parametrize("files", [1, 7])
def test_kept_slice_equals_current_slice(spark, files):
    from checks.sqlkit import written

    n = F.col("id")
    rows = spark.range(0, 90_000, 1, files).select(
        F.when(n % 50 != 7, (n % 20_011).cast("string")).alias("k"), (n % 3).cast("int").alias("k2"),
        F.when(n % 11 != 3, F.date_add(F.lit("2007-01-01").cast("date"), (n % 700).cast("int"))).alias("start_dt"),
        F.when(n % 13 != 4, F.date_add(F.lit("2008-03-01").cast("date"), (n % 400).cast("int"))).alias("end_dt"),
        F.when(n % 5 == 1, F.lit(" d ")).when(n % 5 == 2, F.lit("U")).alias("ctl_action"), n.alias("ctl_loading"), F.concat(F.lit("text "), n).alias("t"))
    columns = ["t", "k", "ctl_loading"]
    want = current_slice(rows, ["k", "k2"], AS_OF).select(*columns)
    got = kept_slice(rows, ["k", "k2"], AS_OF, columns, written)
    assert got.columns == columns and got.count() > 5_000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_kept_slice_sorts_no_payload(spark):
    held = []
    rows = spark.range(40).select((F.col("id") % 9).alias("k"), F.lit("2008-01-01").cast("date").alias("start_dt"), F.col("id").cast("string").alias("payload"))
    got = kept_slice(rows, ["k"], AS_OF, ["k", "payload"], lambda df: held.append(df) or df)
    assert len(held) == 2 and "payload" in held[0].columns
    assert "payload" not in held[1]._jdf.queryExecution().optimizedPlan().toString()  # neither ranked nor shuffled
    assert got.columns == ["k", "payload"]


def test_written_frames_leave_no_shuffle_files(spark):
    from checks.sqlkit import written

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    seen = []
    real = spark.conf.set
    frame = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    try:
        spark.conf.set = lambda k, v: seen.append((k, str(v).lower())) or real(k, v)
        assert written(frame).count() == 7
    finally:
        spark.conf.set = real
    assert seen[0] == (key, "true") and spark.conf.get(key) == before


def test_enrichment_meets_only_the_findings_it_explains(spark):
    from modelwarden.plans import development as dev

    day = lambda n: F.lit(f"2008-01-0{n}").cast("timestamp")
    mv = spark.range(3).select(
        F.col("id").cast("string").alias("model_ver_sid"), day(1).alias(dev.PLAN_START), day(2).alias(dev.FACT_START), day(5).alias(dev.PLAN_END), day(7).alias(dev.FACT_END))
    valid = spark.range(3).select(
        F.concat(F.lit("v"), F.col("id")).alias("valid_sid"), F.col("id").cast("string").alias("model_ver_sid"), *[day(3).alias(f"valid_{c}_dttm") for c in ("crtn", "start_fact", "end_fact")],
        F.lit("DONE").alias("valid_stts_name"), F.lit("RED").alias("valid_rslt_name"), F.lit("no data").alias("valid_dev_return_reason_txt"))
    metric = spark.createDataFrame([("m1", "GINI", "x")], "metric_sid string, metric_name string, metric_val string")
    durations = spark.createDataFrame([("0", 4.0, 5.0), ("1", 4.0, 5.0)], "model_ver_sid string, limit double, days double")
    groups = spark.createDataFrame([("1", "s1", "GINI", 2)], "model_ver_sid string, sample_data_sid string, metric_key string, repeats long")
    rows = [(9, "0", "0"), (8, "0", "0"), (17, "1", "m1"), (18, "1", "s1:GINI"), (23, "2", "v2"), (23, "1", "v2"), (5, None, "q"), (17, "1", "absent")]
    found = spark.createDataFrame([(*r, "E", "i") for r in rows], "query_id int, model_ver_sid string, source_entity_sid string, source_entity_type string, issue_name string")
    held = []
    got = dev.enriched_detail(found, mv, valid, metric, durations, groups, lambda df: held.append(df) or df)
    assert len(held) == 1
    seen = {(r.query_id, r.model_ver_sid, r.source_entity_sid): (r.checked_days, r.metric_value, r.repeats, r.return_reason, r.end_deviation_days) for r in got.collect()}
    assert seen == {
        (9, "0", "0"): (5.0, None, None, None, 2.0), (8, "0", "0"): (None, None, None, None, 2.0), (17, "1", "m1"): (None, "x", None, None, None),
        (18, "1", "s1:GINI"): (None, None, 2, None, None), (23, "2", "v2"): (None, None, None, "no data", None), (23, "1", "v2"): (None,) * 5,
        (5, None, "q"): (None,) * 5, (17, "1", "absent"): (None,) * 5}


def test_audit_and_sheet_hold_what_they_join(spark):
    from modelwarden.plans.audit import summary_sheet

    at = F.lit("2008-01-01").cast("timestamp")
    valid = spark.range(6).select(
        (F.col("id") % 2).cast("string").alias("model_ver_sid"), F.col("id").cast("string").alias("valid_sid"), at.alias("valid_start_fact_dttm"), at.alias("valid_crtn_dttm"),
        at.alias("valid_end_fact_dttm"), F.lit(None).cast("string").alias("valid_dev_return_reason_txt"), F.lit("DONE").alias("valid_stts_name"), F.lit("RED").alias("valid_rslt_name"))
    detail = spark.createDataFrame([("0", 1), ("0", 2)], "model_ver_sid string, query_id int")
    perimeter = spark.createDataFrame([("0",), ("5",)], "model_ver_sid string")
    held = []
    got = {r.model_ver_sid: (r.check_01, r.check_02, r.validation_records) for r in summary_sheet(perimeter, detail, valid, [1, 2], lambda df: held.append(df) or df).collect()}
    assert got == {"0": (1, 1, 3), "5": (0, 0, None)} and len(held) == 3  # matrix, validations, attempts
