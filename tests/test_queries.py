"""Registered queries: SQL twins on the smallest data, and shapes of physical plans."""

import re

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

TWINS = (
    "dev_control_09", "dev_control_16", "portfolio_05", "portfolio_20", "field_statistics", "log_reversals", "log_change_sequence_certain",
    "split_group_temporal", "sample_category_quota", "drift_psi_numeric", "eval_frozen_threshold", "boot_rows", "trial_pareto_three", "text_predicates",
    "fold_jaccard", "trial_confirmation_summary", "state_certainty", "life_card", "life_card_business_names", "life_event_log", "log_link_stats",
    "dev_control_27", "dev_not_assessable", "portfolio_36", "card_flags", "join_closure", "boot_clusters", "boot_winner", "state_read", "audit_attempts", "trial_running_plateau",
)


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", TWINS)
def test_twin(spark, sf, con, name):
    state, _, _, note = compare(spark, sf, name, entry.queries()[name], entry.oracle_sql()[name], con)
    assert state == "ok", note


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 200


def test_entry(spark):
    assert entry.entry(spark).count() == 31


def plan(spark, sf, name):
    return entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dev_control_08", "portfolio_44", "log_reversals", "split_group", "eval_metrics", "fold_hash", "trial_pair_frequency"])
def test_no_python_and_no_cartesian_product(spark, sf, name):
    text = plan(spark, sf, name)
    assert not re.search(r"CartesianProduct|PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas", text)


def test_random_split_needs_no_shuffle_of_its_own(spark, sf):
    from checks.modelling import cfg
    from modelwarden.demo import base_table
    from modelwarden.operators import splits
    from pyspark.sql import functions as F

    df = base_table(spark, sf, "orders").withColumn("y", (F.col("o_orderpriority") < "3").cast("int"))
    assert "Exchange" not in splits.split(df, cfg("random"))._jdf.queryExecution().executedPlan().toString()


def test_indicators_read_their_base_once(spark, sf):
    assert plan(spark, sf, "portfolio_50").count("FileScan") <= 1


def test_latest_limits_rows_before_the_shuffle(spark, sf):
    text = plan(spark, sf, "state_take_latest")
    assert text.count("WindowGroupLimit") == 2


def test_scan_reads_only_needed_columns(spark, sf):
    text = plan(spark, sf, "dev_control_10")
    assert "o_totalprice" not in text.split("ReadSchema")[1]
