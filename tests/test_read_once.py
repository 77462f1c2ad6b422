"""Inputs that several results share are read, joined and kept once."""

from pyspark.sql import functions as F

from modelwarden.plans import engine
from modelwarden.plans.spec import Control


def reads(df, marker):
    return df._jdf.queryExecution().optimizedPlan().toString().count(marker)


def test_invariants_read_summary_and_detail_once(spark):
    summary = spark.range(3).select(F.col("id").cast("int").alias("query_id"), F.lit(2).cast("long").alias("numerator"), F.col("id").alias("denominator"))
    detail = spark.range(10, 16).select(
        F.when(F.col("id") > 10, F.col("id").cast("string")).alias("model_ver_sid"), F.when(F.col("id") % 2 == 0, "VALIDATION").when(F.col("id") == 11, "ELSE").alias("source_entity_type"))
    inside = spark.range(13, 20).select(F.col("id").cast("string").alias("model_ver_sid"))
    report = engine.invariant_report(summary, detail, inside, ("VALIDATION",), 5)
    assert {r.invariant: r.rows for r in report.collect()} == {
        "NUMERATOR_RANGE": 2, "CONTROL_COUNT": 2, "UNKNOWN_ENTITY_TYPE": 1, "OUTSIDE_PERIMETER": 3}
    assert reads(report, "Range (0, 3") == 1 and reads(report, "Range (10, 16") == 1


def test_detail_without_dimensions_keeps_the_other_columns(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), (None, "z")], "model_ver_sid string, d string")
    by_row = F.when(F.col("d").isNotNull(), F.concat(F.lit("n:"), "d"))

    def rule(i, name, severity):
        return Control(i, "c", "d", severity, "b", F.lit(True), F.lit(True), ("d", F.col("d")), ("e", F.lit("e")), name, "none")

    controls = [rule(1, "fixed", "HIGH"), rule(2, by_row, "LOW")]
    whole, short = engine.detail({"b": rows}, controls), engine.detail({"b": rows}, controls, dims=False)
    assert sorted(map(str, whole.drop("dim_1_value", "dim_2_value").collect())) == sorted(map(str, short.collect()))
    found = {(r.query_id, r.issue_name, r.model_ver_sid, r.severity, r.dim_1_value) for r in whole.collect()}
    assert found == {(1, "fixed", "a", "HIGH", "x"), (1, "fixed", "b", "HIGH", "$NULL$"), (2, "n:x", "a", "LOW", "x"), (2, "n:y", "a", "LOW", "y"), (2, None, "b", "LOW", "$NULL$")}
    assert "dim_1" not in short._jdf.queryExecution().optimizedPlan().toString()


def test_portfolio_tables_are_kept_once_for_all_queries(spark, sf):
    from modelwarden.demo import AS_OF, Registry
    from modelwarden.plans import portfolio as pf

    held = []

    def hold(df):
        held.append(df)
        return df

    c = pf.Context(Registry.of(spark, sf).current, AS_OF, hold)
    for i in (17, 25, 26, 28):  # these read the newest validation of a version
        pf.result(pf.queries(AS_OF)[i], c)
    assert len(held) == 3  # validations, the newest of them, versions
    assert set(pf.LATEST_COLUMNS) <= set(min(held, key=lambda d: len(d.columns)).columns)


def test_card_is_written_and_its_analytics_rows_are_kept(spark, sf):
    from checks import cards
    from modelwarden.demo import AS_OF, Registry
    from modelwarden.plans import card

    held = []
    card.build_card(Registry.of(spark, sf).raw, AS_OF, lambda df: held.append(df) or df)
    assert "model_ver_prom_expl_flag" in held[0].columns and len(held) == 3
    assert reads(cards.full_card(spark, sf), "InMemoryRelation") == 0


def test_audit_keeps_only_what_the_asked_frames_share(spark, sf):
    from modelwarden.demo import AS_OF, Registry
    from modelwarden.plans.audit import FRAMES, run_audit

    def held(*names):
        kept = []
        r = Registry.of(spark, sf)
        run_audit(r.current, r.raw, AS_OF, hold=lambda df: kept.append(df) or df, names=names)
        return kept

    assert len(held("run_diagnostics")) == 2                      # versions and the context
    assert any("source_entity_sid" in d.columns for d in held(*FRAMES))
    assert not any("source_entity_sid" in d.columns for d in held("version_report"))


def test_thresholds_go_to_the_rows(spark):
    from modelwarden.operators.evaluate import threshold_metrics

    rows = spark.range(40).select((F.col("id") % 3).cast("string").alias("candidate"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 40).alias("score"), F.lit(1.0).alias("weight"))
    limits = rows.select("candidate").distinct().withColumn("threshold", F.lit(0.5))
    assert "strategy=broadcast" in threshold_metrics(rows, ["candidate"], limits)._jdf.queryExecution().optimizedPlan().toString()


def test_bootstrap_rows_are_not_repeated_by_replicate(spark):
    from modelwarden.operators import bootstrap as bo

    rows = spark.createDataFrame(
        [(str(i), c, i % 3 // 2, None if i == 7 else (i * 37 % 100) / 100, float(i % 5), "s") for i in range(60) for c in ("a", "b")],
        "k string, candidate string, y int, score double, weight double, stratum string")
    for replicates in (3, 30):
        drawn = bo.draws(rows, ["k"], replicates, "x")
        spot = F.least(F.floor(F.col("score") * 8), F.lit(7)).cast("int").alias("bin")
        plain = drawn.groupBy("replicate", "candidate", "y", spot).agg(F.sum(F.col("weight") * F.col("times")).alias("w"), F.max("score").alias("high"))
        got = bo._histogram(rows, ["k"], ["y"], replicates, "x", 8)
        assert {tuple(r) for r in got.select(*plain.columns).collect()} == {tuple(r) for r in plain.collect()}
        assert reads(got, "Generate explode") == 1 and reads(got, "Generate inline") == 1
        text = got._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("Generate inline") < text.index("Aggregate")  # replicates become rows above the sums, not below


def test_bootstrap_of_rows_that_hold_all_candidates(spark):
    from modelwarden.operators import bootstrap as bo

    pairs = F.array(*[F.struct(F.lit(c).alias("candidate"), ((F.col("id") * n % 100) / 100).alias("score")) for c, n in (("a", 37), ("b", 61))])
    whole = spark.range(80).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 9).cast("string").alias("g"), (F.col("id") % 3 % 2).cast("int").alias("y"), F.lit(1.0).alias("weight"),
        F.when(F.col("id") != 5, pairs).alias("scores"))
    long = bo.by_candidate(whole)
    assert long.count() == 158
    held = []
    keep = lambda df: held.append(df) or df
    rounded = lambda df: {(r.replicate, r.candidate, round(r.auc or 0, 9), round(r.average_precision or 0, 9)) for r in df.collect()}
    assert rounded(bo.row_bootstrap(whole, "k", 6, "x", 64, hold=keep)) == rounded(bo.row_bootstrap(long, "k", 6, "x", 64))
    assert rounded(bo.cluster_bootstrap(whole, "g", 6, "x", 64, hold=keep)) == rounded(bo.cluster_bootstrap(long, "g", 6, "x", 64))
    assert len(held) == 3  # histogram, clusters, factors
    text = bo._histogram(whole, ["k"], ["y"], 6, "x", 64)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Generate posexplode") < text.index("md5(")  # draws are found below, before candidates become rows


def test_sums_of_replicates_stay_short_enough_to_be_compiled():
    from modelwarden.operators import bootstrap as bo

    assert bo.TOGETHER <= 8 and bo.TOGETHER % bo.PER_DIGEST == 0
