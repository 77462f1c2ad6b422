"""Toxicity classifier with a counterfactual penalty.

A logistic model over words and word beginnings. Labelled sentences that name a group are copied with the name swapped
for another of its set, and the fit penalises the squared change of the score between the two, so a neutral mention of a
group says nothing about toxicity.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.features import Linear, frequent, in_training, sampled_features, scored, sigmoid, training_sample, word_features

#: Sets of group names that may stand for one another. A parameter; fixed values by default.
GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"), ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "mexican"),
    ("immigrants", "natives"), ("disabled", "abled"), ("old", "young"),
)


def swapped(text: str, groups: tuple[tuple[str, ...], ...] = GROUPS) -> str | None:
    """The text with every group name replaced by the next of its set; None when it names no group."""
    after = {name: group[(k + 1) % len(group)] for group in groups for k, name in enumerate(group)}
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, after)) + r")\b", re.IGNORECASE)
    new, count = pattern.subn(lambda m: after[m.group().lower()], text)
    return new if count else None


def with_swaps(column: pa.Array, groups: tuple[tuple[str, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Word features of a column; the features of swapped copies have their lowest bit set, all others have it clear."""
    one = np.uint64(1)
    rows, codes = word_features(column)
    copies = [(i, swapped(t, groups)) for i, t in enumerate(column.to_pylist()) if t]
    copies = [(i, t) for i, t in copies if t is not None]
    if not copies:
        return rows, codes & ~one
    more, seen = word_features(pa.array([t for _, t in copies]))
    return np.concatenate([rows, np.array([i for i, _ in copies])[more]]), np.concatenate([codes & ~one, seen | one])


def even_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    rows, codes = word_features(column)
    return rows, codes & ~np.uint64(1)


def fit(y: np.ndarray, rows: np.ndarray, codes: np.ndarray, share: float, fair: float = 5.0, ridge: float = 3e-5, steps: int = 400, least: int = 4, sure: float = 3.5) -> Linear:
    """Minimises log loss + fair * mean squared score change under swaps + ridge * |w|^2, by Adam on the whole sample.

    Only features whose counts in the two classes differ by `sure` standard errors take part.
    """
    share = min(max(share, 1e-3), 1 - 1e-3)
    if len(set(y.tolist())) < 2:
        return Linear(np.zeros(0, np.uint64), np.zeros(0), np.log(share / (1 - share)))
    copy = (codes & np.uint64(1)).astype(bool)
    known, rows, at = frequent(rows * 2 + copy, codes & ~np.uint64(1), least)
    copy, rows = rows % 2 == 1, rows // 2
    bad = np.bincount(at[~copy], y[rows[~copy]] / y.mean(), len(known))
    good = np.bincount(at[~copy], (1 - y[rows[~copy]]) / (1 - y.mean()), len(known))
    telling = np.abs(bad - good) >= sure * np.sqrt(bad / y.mean() + good / (1 - y.mean()) + 1e-9)
    place, ok = np.cumsum(telling) - 1, telling[at]
    known, copy, rows, at = known[telling], copy[ok], rows[ok], place[at[ok]]
    named = np.unique(rows[copy])
    plain_rows, plain_at = rows[~copy], at[~copy]
    # Swap differences: +1 for features of the copy, -1 for those of the original, in the named rows only.
    inside = np.isin(rows, named)
    d_rows, d_at, d_sign = np.searchsorted(named, rows[inside]), at[inside], np.where(copy[inside], 1.0, -1.0)
    w, b = np.zeros(len(known)), 0.0
    m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    n = len(y)
    for t in range(1, steps + 1):
        p = sigmoid(b + np.bincount(plain_rows, w[plain_at], n))
        error = (p - y) / n
        grad = np.bincount(plain_at, error[plain_rows], len(w)) + 2 * ridge * w
        if len(named):
            change = np.bincount(d_rows, d_sign * w[d_at], len(named))
            grad += 2 * fair / len(named) * np.bincount(d_at, d_sign * change[d_rows], len(w))
        full = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    prior = np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return Linear(known, w, b + prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = 6000, threshold: float = 0.5, groups: tuple[tuple[str, ...], ...] = GROUPS, fair: float = 5.0) -> DataFrame:
    """The rows of `docs` with score (probability of class 1), predicted (score >= threshold) and held_out.

    The fit uses at most `per_class` labelled rows of each class, none held out; every row is scored over its
    whole text. Null and empty texts get the score of no features. Labels that are null or not 0/1 are passed over;
    without labels of both classes the score is constant. Repeated rows are scored alike.
    """
    sample, share = training_sample(docs, labels, label, per_class, doc, text)
    model = fit(*sampled_features(sample, partial(with_swaps, groups=groups)), share, fair)
    return scored(docs, model, even_words, threshold, doc, text).withColumn("held_out", ~in_training(doc))
