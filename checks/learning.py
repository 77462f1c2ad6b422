"""Subset scoring with Spark ML: results have no SQL twin, so only their rows are checked."""

from __future__ import annotations

from modelwarden.operators import subsets_ml as ml
from pyspark.sql import functions as F

from .modelling import cfg, modelling
from .sqlkit import written
from modelwarden.operators import splits as sp

FEATURES = ("o_totalprice", "c_acctbal", "qty", "hour")
CANDIDATES = {"c1": ("o_totalprice",), "c2": ("o_totalprice", "c_acctbal"), "c3": ("qty", "hour"), "c4": FEATURES}


def parts(s, f):
    d = modelling(s, f).withColumns({"hour": (F.col("o_custkey") % 24).cast("double"), "w": F.lit(1.0), "qty": F.coalesce("qty", F.lit(-1.0)),
                                     "y": (F.col("o_totalprice") + F.col("c_acctbal") * 20 > 320000).cast("int")})
    d = sp.split(d, cfg("random", fractions={"train": 0.6, "valid": 0.4}))
    return d.filter("role = 'train'"), d.filter("role = 'valid'")


def kept_parts(s, f):
    """The parts with what the candidates read, written once: each fit and each scoring would else join and split the tables anew."""
    return tuple(written(d.select(*FEATURES, "y", "w")) for d in parts(s, f))


def r4(df):
    return df.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_scores(s, f):
    return r4(ml.score_subsets(*kept_parts(s, f), CANDIDATES, "y", "w"))


def q_pool(s, f):
    return r4(ml.screening_pool(parts(s, f)[0], FEATURES, "y", "w", 2, 1))


def q_halving(s, f):
    train, valid = kept_parts(s, f)
    screened = ml.as_trials(ml.score_subsets(train, valid, CANDIDATES, "y", "w"))
    return r4(ml.halving_round(screened, lambda c: ml.score_subsets(train, valid, c, "y", "w", (1, 2), ml.logistic), "fixed", 0.5, 2, written))


QUERIES = {"ml_score_subsets": q_scores, "ml_screening_pool": q_pool, "ml_halving_round": q_halving}


def ORACLE():
    return {}
