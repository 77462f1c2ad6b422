"""Embedding near-dedup by counting collisions on one-dimensional projections.

Vectors are put on many random lines. Sorted along one line, each vector opens a window around itself; a pair that
meets in it is counted over a further set of lines, and pairs with a count that linked pairs reach (by the wanted recall)
are verified by their cosine in double precision. A window on one line alone holds a constant share of all rows, so each
sorted line is first cut into cells of a few other lines; several such tables bring the recall back up. Number of cells and
tables follow from the number of vectors and the recall by the normal law of the projections, at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwarden.llm.common import components, spread, stored

WIDTH = 2.0
LINES = 24


def plan(rows: int, cosine: float, recall: float, mates: int = 256) -> dict:
    """Lines a cell, tables, window and least count for a number of rows, a cosine and a recall at that cosine."""
    far, near = math.sqrt(2.0), math.sqrt(max(2.0 - 2.0 * cosine, 1e-6))

    def cell(d: float) -> float:
        r = WIDTH / d
        return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))

    cells = max(1, math.ceil(math.log(max(rows / mates, 1.0) + 1e-9) / -math.log(cell(far))))
    window = 2.0 * near
    inside = math.erf(window / near / math.sqrt(2))
    found = cell(near) ** cells * inside
    tables = max(1, math.ceil(math.log((1 - recall) / 2) / math.log(1 - found))) if found < 1 else 1
    tail, least = 0.0, 0
    for c in range(LINES + 1):
        tail += math.comb(LINES, c) * inside**c * (1 - inside) ** (LINES - c)
        if tail > (1 - recall) / 2:
            least = c
            break
    return {"cells": cells, "tables": tables, "window": window, "least": least}


def _lines(size: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng((seed, size)).standard_normal((size, count))


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _keys(unit: np.ndarray, p: dict, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell keys, places on the sorted lines), one column a table."""
    cells, tables = p["cells"], p["tables"]
    lines = _lines(unit.shape[1], cells * tables + tables, seed)
    shift = np.random.default_rng((seed, 7)).random(cells * tables) * WIDTH
    places = unit @ lines
    grid = np.floor((places[:, : cells * tables] + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), tables, cells)
    key = np.full((len(unit), tables), unit.shape[1], np.uint64)
    for c in range(cells):
        key = spread(key ^ grid[:, :, c], 61 + c)
    return key.view(np.int64), places[:, cells * tables :]


def _linked(unit: np.ndarray, place: np.ndarray, keys: np.ndarray, sorted_places: np.ndarray, table: int, own: np.ndarray | None, p: dict, cosine: float, seed: int) -> list[np.ndarray]:
    """For each row, in order of `place`, the later rows it links to that no earlier table has found."""
    lines = unit @ _lines(unit.shape[1], LINES, seed + 1)
    stop = np.searchsorted(place, place + p["window"], side="right")
    out = []
    for i in range(len(unit)):
        j = np.arange(i + 1, stop[i])
        if own is not None:
            j = j[own[j] != own[i]]
        if len(j):
            j = j[(np.abs(lines[j] - lines[i]) <= p["window"]).sum(axis=1) >= p["least"]]
        if len(j):
            j = j[unit[j] @ unit[i] >= cosine]
        if len(j) and table:
            before = (keys[j, :table] == keys[i, :table]) & (np.abs(sorted_places[j, :table] - sorted_places[i, :table]) <= p["window"])
            j = j[~before.any(axis=1)]
        out.append(j)
    return out


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, recall: float = 0.97, most: int = 4096, seed: int = 8,
) -> DataFrame:
    """One row per row of `vectors`: (vec_id, n_links, component_id, kept) under the name of the key column.

    Rows link when the cosine is `cosine` or more; pairs below never link, pairs right at it are found with at least
    `recall`, closer ones more surely. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. Equal vectors are one row with a weight, so copies are counted and not paired. Vectors of different lengths don't
    link. component_id is the smallest key reachable; null keys are never a name unless there is no other. A cell of more
    than `most` rows is cut into chunks that meet in pairs of tasks. Links are added up where they are found; tasks give
    sums and spanning edges, no pairs.
    """
    value = F.transform(F.col(vector).cast("array<double>"), lambda x: x)
    fine = F.coalesce((F.size(value) > 0) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).cast("long").alias("key"), value.alias("v"), fine.alias("fine"))
    rows = rows.withColumn("id", F.when(F.col("fine"), F.xxhash64("v", F.size("v"))))
    classes = stored(rows.filter("fine").groupBy("id").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")), "classes")
    p = plan(classes.count(), cosine, recall)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                lists = batch.column("v").to_pylist()
                for size in {len(x) for x in lists}:
                    rows_ = np.array([i for i, x in enumerate(lists) if len(x) == size])
                    raw = np.array([lists[i] for i in rows_])
                    keys, _ = _keys(_unit(raw), p, seed)
                    take = pa.array(np.repeat(rows_, p["tables"]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(np.arange(p["tables"], dtype=np.int32), len(rows_))), pa.array(keys.ravel()), batch.column("id").take(take), batch.column("weight").take(take), pa.array([x.tobytes() for x in raw], pa.binary()).take(pa.array(np.repeat(np.arange(len(rows_)), p["tables"])))],
                        ["table", "cell", "id", "weight", "v"],
                    )

    dealt = classes.select("id", "weight", "v").mapInArrow(deal, "table int, cell long, id long, weight long, v binary")
    dealt = stored(dealt, "dealt")
    large = dealt.groupBy("table", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    large = stored(large.select("table", "cell", F.ceil(F.col("n") / most).cast("int").alias("parts")), "large")
    parts = F.coalesce("parts", F.lit(1))
    met = dealt.join(large, ["table", "cell"], "left").withColumn("own", F.pmod(F.xxhash64("id"), parts).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "table", "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "weight", "v"
    )

    def join(block: pa.Table) -> pa.Table:
        ids, weight, own = (block[c].to_numpy() for c in ("id", "weight", "own"))
        table, split = block["table"][0].as_py(), block["x"][0].as_py() != block["y"][0].as_py()
        raw = block["v"].to_pylist()
        out = {"id": [], "n": [], "a": [], "b": []}
        for size in {len(x) for x in raw}:
            pick = np.array([i for i, x in enumerate(raw) if len(x) == size])
            unit = _unit(np.frombuffer(b"".join(raw[i] for i in pick), np.float64).reshape(len(pick), -1))
            keys, places = _keys(unit, p, seed)
            order = np.lexsort((ids[pick], places[:, table]))
            pick, unit, keys, places = pick[order], unit[order], keys[order], places[order]
            links = _linked(unit, places[:, table], keys, places, table, own[pick] if split else None, p, cosine, seed)
            names, n, label = ids[pick], np.zeros(len(pick), np.int64), np.arange(len(pick))
            for i, j in enumerate(links):
                n[i] += weight[pick][j].sum() if len(j) else 0
                n[j] += weight[pick[i]]
            moved = True
            while moved:
                moved = False
                for i, j in enumerate(links):
                    if len(j):
                        low = min(label[i], label[j].min())
                        if label[i] != low or (label[j] != low).any():
                            label[i], moved = low, True
                            label[j] = low
            some = np.flatnonzero(n)
            out["id"].append(names[some])
            out["n"].append(n[some])
            out["a"].append(names[some])
            out["b"].append(names[label[some]])
        return pa.table({c: np.concatenate([*x, np.zeros(0, np.int64)]) for c, x in out.items()})

    found = stored(met.groupBy("table", "cell", "x", "y").applyInArrow(join, "id long, n long, a long, b long"), "found")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.select("a", "b")).withColumnRenamed("node", "id")
    named = classes.select("id", "rep", "weight").join(links, "id", "left").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "component").select(F.col("id").alias("c"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    result = rows.select("key", "id").join(named, F.col("id") == F.col("c"), "left")
    component = F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return result.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
