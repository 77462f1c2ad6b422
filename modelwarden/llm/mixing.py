"""Mixing sources to target weights by entropy balancing.

Rates w of documents that are closest to one copy each in relative entropy, give every source its target of words and
stay under a limit: minimise sum(w log w - w) subject to sum(w * size) = target by source, w <= limit. The dual is
convex, its solution tilts exponentially: w = min(limit, exp(tilt of the source * size)). Newton steps solve for the
tilts; each step is one distributed aggregate over counts by (source, size), which hold all that the sums need.

All sums are of whole numbers (rates in units of 1e-9), so a rerun gives the same mix bit by bit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import positions, stored

UNIT = 1_000_000_000
WHOLE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, total: float, limit: float) -> DataFrame:
    """Adds `target`: shares of `total` by `weight`, none above `limit` times `source_size`.

    What a full source leaves over goes to the others by weight, again and again until none is above. Every round is one
    aggregate of two numbers.
    """
    full = F.col("source_size") * F.lit(float(limit))
    level = 0.0
    while True:
        at = F.col("weight") * F.lit(level) >= full
        taken, weight = sources.agg(
            F.coalesce(F.sum(F.when(at, F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~at, F.col("weight"))), F.lit(0))
        ).first()
        rise = (total - limit * taken) / weight if weight else level
        if rise <= level:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), full))
        level = rise


def newton_tilts(counts: DataFrame, sources: DataFrame, limit: float, rounds: int = 100) -> DataFrame:
    """Adds `tilt` (null where every document stands at the limit) and `unit` to `sources`.

    counts: source, size, n. sources: source, source_size, target. A step that would leave the bracket around the root
    halves the bracket instead. Each round's tilts are a stored table; only the number of open sources is collected.
    """
    moments = counts.filter("size > 0").groupBy("source").agg(
        F.sum(F.col("n").cast(WHOLE) * F.col("size") * F.col("size")).cast("double").alias("squares"), F.min("size").cast("double").alias("least")
    )
    ratio = F.col("target") / F.col("source_size")
    reach = F.col("unit") / F.col("least")  # the smallest document's tilt is the slowest
    start = sources.join(moments.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    start = start.withColumn("unit", F.col("squares") / F.col("source_size")).withColumn("full", ratio >= limit)
    state = stored(start.select(
        "source", "source_size", "target", "unit", F.when(~F.col("full"), F.log(ratio)).alias("tilt"),
        F.when(ratio < 1, F.log(ratio) * reach).otherwise(0.0).alias("low"), F.when(ratio > 1, F.log(F.lit(float(limit))) * reach).otherwise(0.0).alias("high"),
        F.col("full").alias("done"),
    ), "tilts")
    goal = (F.col("target") * UNIT).cast(WHOLE)
    for _ in range(rounds):
        if not state.filter("not done").count():
            return sources.join(
                state.select(F.col("source").alias("source_"), "tilt", "unit"), F.col("source").eqNullSafe(F.col("source_")), "left"
            ).drop("source_")
        rows = counts.join(state.filter("not done").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("w", rate(limit))
        words = F.col("w").cast(WHOLE) * F.col("n") * F.col("size")
        sums = rows.groupBy("s").agg(
            F.sum(words).alias("value"), F.sum(F.when(F.col("w") < limit * UNIT, words * F.col("size"))).cast("double").alias("slope")
        )
        now = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        over = F.col("value") - goal
        now = now.withColumns({"low": F.when(over < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))})
        step = F.col("tilt") - over.cast("double") * F.col("unit") / F.col("slope")
        inside = F.when((step > F.col("low")) & (step < F.col("high")), step).otherwise((F.col("low") + F.col("high")) / 2)
        near = F.coalesce(F.abs(over).cast("double") <= F.greatest(F.col("target") * (UNIT * 1e-7), F.lit(UNIT / 2)), F.lit(True)) | (F.col("low") == F.col("high")) | F.col("done")
        state = stored(now.select("source", "source_size", "target", "unit", F.when(near, F.col("tilt")).otherwise(inside).alias("tilt"), "low", "high", near.alias("done")), "tilts")
    raise RuntimeError("tilts did not settle")


def rate(limit: float) -> Column:
    """Copies of a document in units of 1e-9, from `tilt`, `unit` and `size`."""
    power = F.least(F.col("tilt") * F.col("size") / F.col("unit"), F.lit(math.log(limit)))
    return F.coalesce(F.least(F.floor(F.exp(power) * UNIT).cast("long"), F.lit(int(limit * UNIT))), F.lit(int(limit * UNIT)))


def _rounded(sizes: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of a source, largest documents first; what rounding leaves goes to the next size.

    So the error at the end is about half the size of the smallest documents. A source has at most as many sizes as its
    longest text has words, however many documents there are.
    """
    sizes, carry, copies = sizes.sort_values("size", ascending=False), 0, []
    for size, n, w in zip(sizes["size"].tolist(), sizes["n"].tolist(), sizes["w"].tolist(), strict=True):
        least, most = n * (w // UNIT), n * -(-w // UNIT)
        carry += n * w * size
        copies.append(min(max((2 * carry + size * UNIT) // (2 * size * UNIT), least), most) if size else least)
        carry -= copies[-1] * size * UNIT
    return sizes.assign(each=sizes["w"] // UNIT, more=[k - n * (w // UNIT) for k, n, w in zip(copies, sizes["n"].tolist(), sizes["w"].tolist(), strict=True)])


def mix(docs: DataFrame, share: float = 1.5, limit: float = 2.0, weights: Sequence[int] = (5, 2, 1), size: Column | None = None) -> DataFrame:
    """Copies of each document so that sources weigh as wanted: doc_id, source, size, source_size, target, rate, copies, taken.

    Sources in code point order, null last, take `weights` in turn; together they take `share` times all words, none
    more than `limit` (a whole number) times its own. taken = copies * size.

    Cases: a null or empty text has size 0, one copy and takes nothing; a null source is one source; equal rows are
    documents of their own, which of them gets an additional copy cannot be told from the result; null and repeated ids
    are kept; other columns are left out; a table without words takes none; an empty table gives no row. A source whose
    target is its limit takes `limit` copies of all. Where few documents hold a source's words, copies cannot come
    nearer to its target than about half of its smallest text.
    """
    if limit != int(limit):
        raise ValueError("limit: a whole number of copies")
    size = word_count(F.col("text")) if size is None else size
    base = stored(docs.select("doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("__order")), "sizes")
    counts = stored(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = positions(sources, [], [F.col("source").asc_nulls_last()], "place").drop("group_size")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sources = stored(sources.select("source", "source_size", cycle[(F.col("place") % len(weights)).cast("int")].alias("weight")), "sources")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    sources = stored(water_fill(sources, total, limit), "targets")
    tilts = newton_tilts(counts, sources.filter("source_size > 0").select("source", "source_size", "target"), limit).select(F.col("source").alias("s"), "tilt", "unit")
    copied = F.when(F.col("size") == 0, F.lit(UNIT)).otherwise(rate(limit)).cast("long")
    rates = counts.join(tilts, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "size", "n", copied.alias("w"))
    rates = rates.groupBy("source").applyInPandas(_rounded, "source string, size long, n long, w long, each long, more long")
    kinds = stored(rates.join(sources.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", (F.col("w") / UNIT).alias("rate"), "each", "more"
    ), "copies")
    placed = positions(base, ["source", "size"], [F.col("__order"), F.col("doc_id")])
    found = placed.join(kinds, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    copies = F.col("each") + F.when(F.col("pos") < F.col("more"), 1).otherwise(0)
    return found.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
