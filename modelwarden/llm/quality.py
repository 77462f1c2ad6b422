"""Quality classifier: Naive Bayes support vectors.

N-gram indicators are scaled by the log-count ratio of the two classes; a linear model with hinge loss is fitted on them
by dual coordinate descent; its margins become probabilities by a logistic fit with the prior of all training labels.
The n-grams are those of token shapes (case, digits, marks, repetition), which are comparable across languages.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.features import Linear, frequent, in_training, sampled_features, scored, shape_features, sigmoid, training_sample


def log_count_ratio(y: np.ndarray, rows: np.ndarray, at: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    """Log of the ratio of smoothed, normalised indicator counts of class 1 and class 0."""
    good = smooth + np.bincount(at, y[rows] == 1, size)
    bad = smooth + np.bincount(at, y[rows] == 0, size)
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_coordinate_descent(sign: np.ndarray, lists: list[np.ndarray], scale: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Minimises |w|^2 / 2 + cost * sum of hinge losses of sign * (w.x + b), x being `scale` on the listed features."""
    w, b = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(sign))
    norm = np.array([float((scale[x] ** 2).sum()) + 1.0 for x in lists])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(sign)):
            x = lists[i]
            slope = sign[i] * (float(w[x] @ scale[x]) + b) - 1.0
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[x] += step * scale[x]
                b += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w, b


def logistic_line(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) of the weighted logistic fit P(y=1) = sigmoid(a * margin + b), by damped Newton steps."""
    a, b = 1.0, 0.0
    target = np.where(y == 1, 0.99, 0.01)
    for _ in range(50):
        p = sigmoid(a * margin + b)
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * margin).sum(), g.sum()])
        curve = np.array([[(h * margin * margin).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(y: np.ndarray, rows: np.ndarray, codes: np.ndarray, share: float, cost: float = 0.1, epochs: int = 20, least: int = 3, seed: int = 10) -> Linear:
    """A model from distinct (row, hash) features; with one class only, the constant share."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    if len(set(y.tolist())) < 2:
        return Linear(np.zeros(0, np.uint64), np.zeros(0), np.log(share / (1 - share)))
    known, rows, at = frequent(rows, codes, least)
    ratio = log_count_ratio(y, rows, at, len(known))
    lists = np.split(at, np.searchsorted(rows, np.arange(1, len(y))))
    w, b = dual_coordinate_descent(np.where(y == 1, 1.0, -1.0), lists, ratio, cost, epochs, seed)
    weights = w * ratio
    margin = b + np.bincount(rows, weights[at], len(y))
    a, c = logistic_line(margin, y, np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())))
    return Linear(known, a * weights, a * b + c)


def quality_scores(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = 6000, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` with score (probability of class 1), predicted (score >= threshold) and held_out.

    The fit uses at most `per_class` labelled rows of each class, none held out; every row is scored over its
    whole text. Null and empty texts get the score of no features. Labels that are null or not 0/1 are passed over;
    without labels of both classes the score is constant. Repeated rows are scored alike.
    """
    sample, share = training_sample(docs, labels, label, per_class, doc, text)
    model = fit(*sampled_features(sample, shape_features), share)
    return scored(docs, model, shape_features, threshold, doc, text).withColumn("held_out", ~in_training(doc))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with their own columns."""
    return quality_scores(docs, labels, **options).filter(F.col("predicted") == 1).select(*docs.columns)
