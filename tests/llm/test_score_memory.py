"""Scoring holds short slices of a batch, with the same scores."""

import numpy as np

from modelwarden.llm import features


def test_scoring_holds_short_slices(spark):
    def featurise(column):
        if column.nbytes > 2_000_000:
            raise ValueError(f"a slice of {column.nbytes} bytes")
        return features.word_features(column)

    docs = spark.createDataFrame([(i, "some words " * 20_000) for i in range(30)], "doc_id long, text string").coalesce(1)
    model = features.Linear(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    assert features.scored(docs, model, featurise, 0.5).filter("score = 0.5").count() == 30
