"""Substring dedup by hashing of lines and the sentences in them.

A line is the run of its sentences, and every word of a text is in a hashed unit: a sentence that is short for a unit is
joined to those after it and to those before it. So a repeated line, or a run of whole sentences, of the least words of a
unit or more is found whole, wherever it starts. Units are normalised and digested, digests are grouped over the whole
corpus, the earliest place (lowest document id, then offset) stays and every other place goes. Removed neighbours are
joined to passages with their offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelwarden.llm.common import slices

#: A sentence is the longest run without a line break that ends at a sentence end before white space, or at the line's end.
SENTENCE = re.compile(r"\S[^\n]*?(?:[.!?]+(?=\s)|(?=\n)|\Z)")


def units_of(text: str, least_words: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Start, end, first word, words and digest of each unit; case and blanks don't count.

    Sentences of `least_words` words or more are units. From a shorter one, one unit runs on and one runs back, across
    line breaks, over as few sentences as make `least_words` words; a text that has fewer is one unit.
    """
    found = [(m.start(), m.end(), m.group().lower().split()) for m in SENTENCE.finditer(text)]
    words = [w for _, _, ws in found for w in ws]
    at = [0]
    for _, _, ws in found:
        at.append(at[-1] + len(ws))
    spans = {}
    for i in range(len(found)):
        j = i + 1
        while j < len(found) and at[j] - at[i] < least_words:
            j += 1
        spans[i, j] = at[j] - at[i] >= least_words
        k = i
        while k and at[i + 1] - at[k] < least_words:
            k -= 1
        spans[k, i + 1] = at[i + 1] - at[k] >= least_words
    for (i, j), full in sorted(spans.items()):
        if full or (i == 0 and j == len(found)):
            digest = hashlib.blake2b(" ".join(words[at[i] : at[j]]).encode(), digest_size=16).digest()
            yield found[i][0], found[j - 1][1], at[i], at[j] - at[i], digest


def units(docs: DataFrame, least_words: int = 4, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc, twin, first, stop, word, words, h1, h2): the units of each text; null texts have none.

    `first` and `stop` are code points, `word` is the place of the first word in the text, from 0, `twin`
    keeps apart rows of one id with different texts.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(text).alias("twin"), F.col(text).alias("text")).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            found = [[*units_of(t, least_words)] for t in batch.column("text").to_pylist()]
            sizes = np.array([len(x) for x in found])
            flat = [u for x in found for u in x]
            take = pa.array(np.repeat(np.arange(len(found)), sizes))
            digest = np.frombuffer(b"".join(u[4] for u in flat), np.int64).reshape(-1, 2)
            ints = [pa.array(np.array([u[k] for u in flat], np.int32)) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(take), batch.column("twin").take(take), *ints, pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())],
                ["doc", "twin", "first", "stop", "word", "words", "h1", "h2"],
            )

    return rows.mapInArrow(run, "doc long, twin long, first int, stop int, word int, words int, h1 long, h2 long")


def repeated_passages(docs: DataFrame, least_passage: int = 20, least_words: int = 4, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages to remove: rows (doc_id, start, end, n_words, n_units, kept_doc_id, kept_start).

    A passage is a run of overlapping or neighbouring units that each occur earlier in the corpus, of at least
    `least_passage` words in all (fewer than `least_words` words between them belong to it, but don't count).
    `kept_doc_id` and `kept_start` are the place that stays for its first unit, the longest of those that start there.
    A passage that starts or ends inside a sentence is found by its whole sentences only. Ties in rank (repeated
    rows of one id and text) are one place, so repeated rows lose nothing; null ids rank last. Empty tables and texts give no rows. Digest groups are combined before the shuffle; the join back is an
    ordinary join that Spark splits where a digest is hot.
    """
    found = units(docs, least_words, doc, text).withColumn("rank", F.coalesce("doc", F.lit(2**63 - 1)))
    place = F.struct("rank", "twin", "first")
    repeats = found.groupBy("h1", "h2").agg(F.min(place).alias("kept"), F.max(place).alias("last")).filter("kept <> last")
    gone = found.join(repeats.drop("last"), ["h1", "h2"]).filter(place != F.col("kept")).select(
        "doc", "rank", "twin", "first", "stop", "word", "words", F.col("kept.rank").alias("kept_doc_id"), F.col("kept.first").alias("kept_start")
    )
    ordered = Window.partitionBy("rank", "twin").orderBy("word", "words")
    last, covered = F.col("word") + F.col("words"), F.coalesce("covered", F.lit(0))
    gone = gone.distinct().withColumn("covered", F.max(last).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    gone = gone.withColumn("run", F.sum((F.col("word") - covered >= least_words).cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    gone = gone.withColumn("fresh", F.greatest(last - F.greatest("word", covered), F.lit(0)))
    return (
        gone.groupBy("rank", "twin", "run")
        .agg(
            F.first("doc").alias("doc_id"), F.min("first").cast("long").alias("start"), F.max("stop").cast("long").alias("end"),
            F.sum("fresh").alias("n_words"), F.count(F.lit(1)).alias("n_units"),
            F.min(F.struct("word", -F.col("words"), "kept_doc_id", "kept_start")).alias("k"),
        )
        .filter(F.col("n_words") >= least_passage)
        .select("doc_id", "start", "end", "n_words", "n_units", F.col("k.kept_doc_id").alias("kept_doc_id"), F.col("k.kept_start").cast("long").alias("kept_start"))
    )


def remove_passages(docs: DataFrame, passages: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with the passages of `repeated_passages` cut out of `text`; ids should be unique here."""
    spans = passages.groupBy(F.col("doc_id").alias("__doc")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    joined = docs.join(spans, F.col(doc) == F.col("__doc"), "left")
    starts = F.transform(F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda s: s["end"])), lambda e: e)
    ends = F.concat(F.transform("__spans", lambda s: s["start"]), F.array(F.length(text).cast("long")))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.substring(F.col(text), (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.array_join(parts, ""))
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])
