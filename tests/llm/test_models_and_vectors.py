"""Vectors against brute force, classifiers by held-out accuracy, the pipeline by its parts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from modelwarden.llm import embeddings, quality, toxicity
from modelwarden.llm.common import components, stored
from modelwarden.llm.features import Linear


@pytest.mark.parametrize("most", [4096, 60])
def test_vectors_link_as_brute_force(spark, most):
    rng, size = np.random.default_rng(0), 32
    centres = rng.standard_normal((20, size))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = []
    for i in range(600):
        b, z = centres[i % 20], rng.standard_normal(size)
        z -= (z @ b) * b
        c = rng.uniform(0.87, 1)
        rows.append((i, [float(x) for x in (c * b + np.sqrt(1 - c * c) * z / np.linalg.norm(z)).astype(np.float32) * 3]))
    rows += [(1000 + i, rows[0][1]) for i in range(20)]
    odd = [(2000, None), (2001, []), (2002, [0.0] * size), (2003, [float("nan")] * size), (2004, [None] + [1.0] * 31), (None, [float("inf")] * size)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embeddings.near_vectors(df, most=most).collect()}
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = (v @ v.T >= 0.9).sum(axis=1) - 1
    mine = np.array([got[r[0]].n_links for r in rows])
    assert (mine <= want).all() and mine.sum() >= 0.97 * want.sum()
    assert all(got[k].n_links == 0 and got[k].component_id == k for k in (2000, 2001, 2002, 2003, 2004))
    assert all(got[1000 + i].component_id == 0 and not got[1000 + i].kept for i in range(20)) and len(got) == len(rows) + len(odd)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}


def scores(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality_scores(docs, labels, per_class=500).filter("held_out").join(labels, "doc_id").select("predicted", "quality").toPandas()
    assert (got.predicted == got.quality).mean() > 0.97
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity_scores(docs, labels).filter("held_out").join(labels, "doc_id").select("predicted", "toxic", "score").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.95 and got.score.between(0, 1).all()


@pytest.mark.parametrize("run", [quality.quality_scores, toxicity.toxicity_scores])
def test_scores_of_odd_rows(spark, run):
    docs = scores(spark, [(1, None, "a"), (2, "", "a"), (2, "", "a"), (None, "word", "a"), (3, "x " * 50000, "a")])
    for labels in ([], [(1, 1, 1)], [(1, None, 0), (2, 1, 1), (3, 0, 0), (7, 5, 5), (3, 0, 0)]):
        got = run(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    lists = [np.unique(np.append(rng.integers(2, 30, 6), y)) for y in (0, 1) * 100]
    sign = np.array([-1.0, 1.0] * 100)
    w, b = quality.dual_coordinate_descent(sign, lists, np.ones(30), 1.0, 100, 0)
    margin = np.array([w[x].sum() + b for x in lists])
    assert ((margin * sign) > 0.9).all()
    loss = lambda w, b: (w @ w + b * b) / 2 + np.maximum(0, 1 - sign * np.array([w[x].sum() + b for x in lists])).sum()
    assert all(loss(w + rng.normal(0, 0.05, 30), b) >= loss(w, b) - 1e-2 for _ in range(50))


def test_swaps_take_the_group_out_of_the_score():
    texts = ["women talk idiot %d" % i for i in range(60)] + ["men talk nice %d" % i for i in range(60)] + ["women talk nice"] * 5 + ["men talk idiot"] * 5
    y = np.array([1] * 60 + [0] * 60 + [0] * 5 + [1] * 5)
    rows, codes = toxicity.with_swaps(pa.array(texts), toxicity.GROUPS)
    pairs = np.unique(np.stack([rows.astype(np.uint64), codes], 1), axis=0)
    gap = {}
    for fair in (0.0, 50.0):
        model = toxicity.fit(y, pairs[:, 0].astype(np.int64), pairs[:, 1], 0.5, fair)
        a, b = (model.margins(*toxicity.even_words(pa.array([t])), 1)[0] for t in ("women talk", "men talk"))
        gap[fair] = abs(a - b)
    assert gap[50.0] < 0.2 * gap[0.0]
    assert toxicity.swapped("Women and OLD men") == "men and young women" and toxicity.swapped("none") is None


def test_linear_counts_a_feature_once():
    model = Linear(np.array([5, 9], np.uint64) << np.uint64(50), np.array([1.0, 2.0]), 0.5)
    codes = np.array([5, 5, 9, 7], np.uint64) << np.uint64(50)
    assert model.margins(np.array([0, 0, 1, 1]), codes, 3).tolist() == [1.5, 2.5, 0.5]


def test_pipeline_stages(spark, sf):
    first, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    docs = first
    for name, stage in corpus_pipeline.STAGES:
        out = docs = stored(stage(spark, docs, sf))
        ids = {r[0] for r in out.select("doc_id").collect()}
        kept.append(ids)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == first.columns
    assert kept[1] == kept[0] and kept[2] <= kept[1] and kept[3] <= kept[2] and kept[4] == kept[3] and 0 < len(kept[4]) < first.count()
    final = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in final.collect()} == kept[4]
    assert final.filter(F.col("n_tokens") != F.size("ids")).count() == 0
