"""Hashed text features of whole Arrow columns, and linear models over a bounded set of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwarden.llm.common import lowered, released, slices, span_hashes, spread, utf8, word_bounds

#: Word bytes: ASCII letters and digits, and all bytes of other characters.
LETTERS = np.array([chr(c).isalnum() or c > 127 for c in range(128)] + [True] * 128)
#: Bytes of tokens between blanks.
INK = np.array([c not in (9, 10, 11, 12, 13, 32) for c in range(256)])
#: Class of each byte in a shape: capital, small letter (and all beyond ASCII), digit, or the byte itself.
CLASS = np.array([65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c > 127 else 48 if 48 <= c <= 57 else c for c in range(256)], np.uint8)


def grams(codes: np.ndarray, rows: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, hashes) of the n-grams of n = 1 to `most` tokens; none crosses rows."""
    out, grown = [(rows, spread(codes, 11))], codes
    for n in range(2, most + 1):
        if len(codes) < n:
            break
        grown = spread(grown[: len(codes) - n + 1] + np.uint64(n), 12) ^ codes[n - 1 :]
        same = rows[: len(codes) - n + 1] == rows[n - 1 :]
        out.append((rows[: len(codes) - n + 1][same], spread(grown[same], 11)))
    return out


def shape_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-grams (1 to 3) of token shapes. A shape is the token's byte classes, runs as one; a repeated token is marked."""
    raw, offsets = utf8(column)
    rows, starts, ends = word_bounds(raw, offsets, INK)
    classes = CLASS[raw]
    fresh = np.ones(len(raw), bool)
    fresh[1:] = classes[1:] != classes[:-1]
    fresh[starts] = True
    place = np.concatenate([[0], np.cumsum(fresh)])
    packed = np.concatenate([classes[fresh], np.zeros(8, np.uint8)])
    codes = span_hashes(packed, place[starts], place[ends] - place[starts])
    words = span_hashes(lowered(raw), starts, ends - starts)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    codes[again] = spread(np.uint64(7) + np.zeros(int(again.sum()), np.uint64), 13)
    found = grams(codes, rows, 3)
    return np.concatenate([r for r, _ in found]), np.concatenate([h for _, h in found])


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words, and beginnings of four and five bytes of longer words."""
    raw, offsets = utf8(column)
    rows, starts, ends = word_bounds(raw, offsets, LETTERS)
    low, sizes = lowered(raw), ends - starts
    found = [(rows, spread(span_hashes(low, starts, sizes), 21))]
    for n in (4, 5):
        longer = np.flatnonzero(sizes > n)
        found.append((rows[longer], spread(span_hashes(low, starts[longer], np.full(len(longer), n)), 21 + n)))
    return np.concatenate([r for r, _ in found]), np.concatenate([h for _, h in found])


class Linear:
    """Weights on feature hashes. `table` passes over hashes that can't be known before the exact look-up."""

    BITS = 22

    def __init__(self, codes: np.ndarray, weights: np.ndarray, bias: float) -> None:
        order = np.argsort(codes)
        self.codes, self.weights, self.bias = codes[order], weights[order], float(bias)
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self.codes >> np.uint64(64 - self.BITS)] = True

    def margins(self, rows: np.ndarray, codes: np.ndarray, count: int) -> np.ndarray:
        """Bias plus the weights of the distinct known features of each row."""
        may = np.flatnonzero(self.table[codes >> np.uint64(64 - self.BITS)])
        rows, codes = rows[may], codes[may]
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        hit = self.codes[at] == codes if len(self.codes) else np.zeros(0, bool)
        pairs = np.unique(rows[hit].astype(np.int64) * len(self.codes) + at[hit]) if len(self.codes) else np.zeros(0, np.int64)
        size = max(len(self.codes), 1)
        return self.bias + np.bincount(pairs // size, self.weights[pairs % size] if len(pairs) else None, count)[:count]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def in_training(doc: str | Column) -> Column:
    """True for ids whose labels may be learned from: crc32 of the id as text is not divisible by 5."""
    return F.coalesce(F.pmod(F.crc32((F.col(doc) if isinstance(doc, str) else doc).cast("string")), F.lit(5)) != 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, doc: str = "doc_id", text: str = "text") -> tuple[DataFrame, float]:
    """(rows (y, text) of at most `per_class` labelled documents of each class, share of class 1 among all training labels).

    Only labels of training ids count. The sample takes the lowest hashes of the ids, so it is the same on every run;
    its bound also bounds the broadcast of its ids.
    """
    known = labels.filter(F.col(label).isin(0, 1) & in_training(doc)).select(F.col(doc).alias("id"), F.col(label).cast("int").alias("y"))
    share = known.agg(F.avg("y")).first()[0]
    picks = None
    for y in (0, 1):
        one = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
        picks = one if picks is None else picks.union(one)
    sample = docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).join(F.broadcast(picks), "id")
    return sample.select("y", "text"), 0.5 if share is None else float(share)


def sampled_features(sample: DataFrame, featurise) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, rows, hashes) of a bounded sample: distinct features by row, made in the tasks and fetched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            rows, codes = featurise(batch.column("text"))
            order = np.lexsort((codes, rows))
            rows, codes = rows[order], codes[order]
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])
            ends = np.searchsorted(rows[fresh], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(codes[fresh].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("y"), lists], ["y", "codes"])

    got = sample.mapInArrow(released(run), "y int, codes array<long>").toArrow()
    lists = got["codes"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    y = got["y"].to_numpy().astype(np.int64)
    order = np.argsort(got["y"].to_numpy(), kind="stable")  # the order of tasks must not matter
    sizes = np.diff(lists.offsets.to_numpy())
    codes = lists.flatten().to_numpy().view(np.uint64)
    first = np.array([codes[a] if n else 0 for a, n in zip(lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0], sizes)], np.uint64)
    order = np.lexsort((first, sizes, y))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    rows = np.repeat(rank, sizes)
    by = np.lexsort((codes, rows))
    return y[order], rows[by], codes[by]


def frequent(rows: np.ndarray, codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known hashes, rows, positions) after dropping hashes seen in fewer than `least` rows."""
    known, at, seen = np.unique(codes, return_inverse=True, return_counts=True)
    keep = seen >= least
    new = np.cumsum(keep) - 1
    ok = keep[at]
    return known[keep], rows[ok], new[at[ok]]


def scored(docs: DataFrame, model: Linear, featurise, threshold: float, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (all columns of `docs`, score double, predicted int); null and empty texts score by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast((model.codes, model.weights, model.bias))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear = Linear(*shared.value)
        for batch in slices(batches, text, 1_000_000):
            rows, codes = featurise(batch.column(text))
            score = sigmoid(linear.margins(rows, codes, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*kept, "score", "predicted"]
            )

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*kept).mapInArrow(released(run), schema)
