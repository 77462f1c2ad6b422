"""Files, catalogues, exports, reconciliation and the assembled audit."""

import tempfile

import pytest
from pyspark.sql import functions as F

from modelwarden.demo import AS_OF, Registry
from modelwarden.operators import reconcile, splits
from modelwarden.plans import audit, card
from modelwarden.sources import catalog, contract, files


def folder():
    return tempfile.mkdtemp(prefix="run-")


def test_parquet_round_trip(spark):
    path = folder() + "/t"
    df = spark.range(10).withColumn("r", F.col("id") % 2)
    files.write_parquet(df, path, partition_by=["r"])
    assert files.scan_parquet(spark, path).count() == 10
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_parquet(df, path)
    files.write_parquet(df, path, overwrite=True)
    inv = files.parquet_inventory(spark, path).first()
    assert inv.rows == 10 and inv.files >= 2 and inv.bytes > 0
    with pytest.raises(FileNotFoundError):
        files.scan_parquet(spark, folder() + "/nothing/*.parquet").count()


def test_json_lines_skip_torn_rows(spark):
    path = folder() + "/log"
    spark.createDataFrame([('{"fidelity":"a","n_features":2}',), ('{"fidelity":"b"',), ("17",)], "value string").write.text(path)
    assert [r.fidelity for r in files.read_json_lines(spark, path).collect()] == ["a"]


def test_export_limit(spark):
    df = spark.range(5).select(F.array("id").alias("a"), F.current_date().alias("d"))
    out = files.export_limited(df, 5)
    assert dict(out.dtypes) == {"a": "string", "d": "string"}
    with pytest.raises(ValueError):
        files.export_limited(df, 4)


def test_schema_agreement_and_status(spark):
    a = spark.createDataFrame([(1, "x")], "p int, q string")
    rows = contract.schema_agreement({"train": a, "valid": a.withColumn("p", F.lit(1.0)), "oos": a.drop("q")}, "train").collect()
    assert {(r.role, r.column_name) for r in rows} == {("valid", "p"), ("oos", "q")}

    def broken():
        raise ValueError("gone")

    got = {r.table_name: r.status for r in catalog.table_status(spark, {"a": lambda: a, "b": broken}).collect()}
    assert got == {"a": "OK", "b": "ERROR"}


def test_reconciliation_finds_exactly_the_edits(spark, sf):
    full = card.build_card(Registry.of(spark, sf).raw, AS_OF).persist()
    key = full.orderBy("model_ver_sid").first().model_ver_sid
    edit = full.withColumn("F01_MODEL_CODE", F.when(F.col("model_ver_sid") == key, 1 - F.col("F01_MODEL_CODE")).otherwise(F.col("F01_MODEL_CODE")))
    cells = reconcile.cell_mismatches(edit, full, "model_ver_sid", card.FLAGS).collect()
    assert [(r.model_ver_sid, r.check_name) for r in cells] == [(key, "F01_MODEL_CODE")]
    assert reconcile.verdict(full, full, "model_ver_sid", card.FLAGS, "model_ver_signfcnt_ctgry_code").first().status == "OK"
    assert reconcile.verdict(edit, full, "model_ver_sid", card.FLAGS, "model_ver_signfcnt_ctgry_code").first().cell_mismatches == 1
    reconcile.assert_report(full, "model_ver_sid", card.FLAGS, "issue_count")
    with pytest.raises(ValueError, match="TOTAL_NOT_SUM"):
        reconcile.assert_report(edit, "model_ver_sid", card.FLAGS, "issue_count")


def test_audit_frames(spark, sf):
    r = Registry.of(spark, sf)
    frames = audit.run_audit(r.current, r.raw, AS_OF, hold=lambda d: d.persist())
    assert frames["control_rollup"].count() == 31
    assert frames["version_context"].count() == frames["run_diagnostics"].first().versions
    assert {"risk_details", "version_report", "model_change_log", "red_production", "invariants"} <= set(frames)
    with pytest.raises(ValueError):
        audit.run_audit(r.current, r.raw, AS_OF, version_mode="newest")


def test_manifest(spark, sf):
    from checks.modelling import cfg, late, modelling

    text = splits.manifest(modelling(spark, sf), cfg("group_temporal"), late(spark, sf)).first().manifest
    assert '"mode":"group_temporal"' in text and '"unaccounted_rows":0' in text
