"""What the summary sheet reads is derived once."""

from pyspark.sql import functions as F


def test_attempts_read_the_validations_once(spark):
    from checks.sqlkit import written
    from modelwarden.plans.audit import attempt_statistics

    at = lambda n: (F.lit("2008-01-01").cast("timestamp") + F.make_dt_interval((F.col("id") * n).cast("int"))).alias
    valid = spark.range(12).select(
        (F.col("id") % 3).cast("string").alias("model_ver_sid"), F.col("id").cast("string").alias("valid_sid"), at(9)("valid_start_fact_dttm"), at(9)("valid_crtn_dttm"),
        at(10)("valid_end_fact_dttm"), F.when(F.col("id") % 2 == 0, "x").alias("valid_dev_return_reason_txt"), F.lit("DONE").alias("valid_stts_name"), F.lit("RED").alias("valid_rslt_name"))
    held = attempt_statistics(valid, written)
    assert sorted(map(str, held.collect())) == sorted(map(str, attempt_statistics(valid).collect()))
    assert "Range (" not in held._jdf.queryExecution().optimizedPlan().toString()


def test_summary_sheet_derives_versions_once(spark, sf, monkeypatch):
    from checks import basics
    from modelwarden.demo import Registry

    Registry._shared.clear()
    derived, current = [], Registry.current
    monkeypatch.setattr(Registry, "current", lambda self, name: derived.append(name) or current(self, name))
    basics.q_summary_sheet(spark, sf)
    assert derived.count("model_ver") == 1
