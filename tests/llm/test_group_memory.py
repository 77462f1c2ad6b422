"""Jaccard workers hold little: shingles in short runs, results of groups in short batches."""

import random

import pyarrow as pa
import pytest


def test_shingles_do_not_depend_on_the_runs_they_are_made_in():
    jaccard = pytest.importorskip("modelwarden.llm.jaccard")
    draw = random.Random(3)
    texts = pa.array([None, "", "one two", *(" ".join(draw.choice("abcdefgh") for _ in range(draw.randint(0, 90))) for _ in range(80))])
    whole, runs = jaccard.shingle_sets(texts, most_bytes=1 << 30), jaccard.shingle_sets(texts, most_bytes=500)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(whole, runs))
    assert [len(x) for x in jaccard.shingle_sets(pa.array([], pa.string()))] == [0, 1]


def test_group_functions_give_short_batches(spark):
    common = pytest.importorskip("modelwarden.llm.common")
    out = list(common.grouped(lambda t: pa.table({"x": t["x"], "n": [t.num_rows] * t.num_rows}), rows=40)(iter([pa.record_batch({"x": list(range(60))}), pa.record_batch({"x": list(range(60, 100))})])))
    assert max(b.num_rows for b in out) <= 40 and [x for b in out for x in b["x"].to_pylist()] == list(range(100)) and out[0]["n"][0].as_py() == 100
    none = spark.range(5).groupBy("id").applyInArrow(common.grouped(lambda t: pa.table({"n": pa.array([], pa.int64())})), "n long")
    assert none.count() == 0
