"""Helpers shared by the operators of this folder: shared storage, Arrow slices, hashing of words, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Models that a Python worker keeps for the next task of the same operator.
KEPT: dict = {}


def trim(collect: bool = True) -> None:
    """Gives memory that the worker no longer uses back to the system."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(run: Callable, keep: bool = False) -> Callable:
    """An Arrow function whose worker, reused by later stages, starts without models of other operators and ends trimmed."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if KEPT and not keep:
            KEPT.clear()
            trim()
        try:
            yield from run(batches)
        finally:
            trim(collect=not keep)  # a kept model has very many objects to walk

    return wrapped


def grouped(run: Callable[[pa.Table], pa.Table], large: int = 1 << 20, rows: int = 50_000) -> Callable:
    """An Arrow function of one group, from one of its table: results go out in batches of `rows`, and a worker gives
    memory back after a group of `large` bytes, so it does not sit idle on the largest group it has met.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if KEPT:
            KEPT.clear()
            trim()
        table = pa.Table.from_batches(list(batches))
        size = table.nbytes
        out = run(table)
        del table
        size += out.nbytes
        yield from out.to_batches(max_chunksize=rows)
        del out
        if size >= large:
            trim(collect=False)

    return wrapped


def plain_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. `lower` does that for ASCII texts, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir.

    Where the setting is absent, a local session gets a temporary folder; a cluster session is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """The rows of `df`, written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with more columns that are worked out once a row, even where lambdas of later expressions use them.

    A generator stands between: the optimiser would otherwise copy an expression into the lambda and repeat it there
    for each array element.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the values of one column hold about `most_bytes` (one row at least)."""
    for batch in batches:
        start, size = 0, batch.num_rows
        if not size:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(lengths)
        while start < size:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def spread(value: np.ndarray, seed: int) -> np.ndarray:
    """Mixes 64-bit values (the finaliser of splitmix64 after adding a seed)."""
    with np.errstate(over="ignore"):
        z = value + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], int(offsets[0])) if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes with `is_word`, never across rows. Gives the row, start and end byte of each."""
    flag = np.concatenate([[False], is_word[raw], [False]])
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(flag[1:-1] & (~flag[:-2] | border[:-1]))
    ends = np.flatnonzero(flag[1:-1] & (~flag[2:] | border[1:])) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def lowered(raw: np.ndarray) -> np.ndarray:
    """A copy with A-Z in lower case, and eight zero bytes at the end, as `span_hashes` wants it."""
    low = np.concatenate([raw, np.zeros(8, np.uint8)])
    low[(low >= 65) & (low <= 90)] += 32
    return low


def span_hashes(padded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, mixed eight bytes at a time, its length included."""
    h = spread(sizes.astype(np.uint64), 1)
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    live, at, left = slice(None), starts, sizes
    while len(at):
        chunk = np.ascontiguousarray(windows[at]).view(np.uint64).ravel()
        rest = np.minimum(left, 8).astype(np.uint64)
        mask = ~np.uint64(0) >> ((np.uint64(8) - rest) * np.uint64(8))
        h[live] = spread(h[live] ^ (chunk & mask), 2)
        more = np.flatnonzero(left > 8)
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component being the smallest node reachable.

    Alternates large-star and small-star steps; each round is written to the shared folder. Nodes without edges
    are absent. Null ends and loops are ignored. Stops with an error when `rounds` are not enough.
    """
    pairs = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    mark = None
    for _ in range(rounds):
        both = pairs.union(pairs.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(lowest, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        pairs = stored(small.filter("u <> v").distinct(), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        mark = now
    raise RuntimeError("components did not settle")


def positions(df: DataFrame, group: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """Numbers the rows of each group from 0 in the given order; `group_size` holds the rows of the group.

    Rows are range-partitioned by group, order and a serial number, so neither a hot group nor a third of equal rows
    makes a large task; a row's place is its place in its partition plus the rows of its group in the partitions
    before. Only one row a partition and group is cumulated. Null is a group of its own, before the others.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by = [*[F.col(c).asc_nulls_first() for c in group], *order]
    # the serial number of a sorted partition: partition above, place in it in the lower 33 bits
    placed = stored(
        df.withColumn("__serial", F.monotonically_increasing_id()).repartitionByRange(parts, *by, F.col("__serial"))
        .sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()).drop("__serial"), "placed",
    ).withColumn("__part", F.shiftright("__at", 33))
    spans = placed.groupBy("__part", *group).agg(F.min("__at").alias("__low"), F.count(F.lit(1)).alias("__n"))
    of = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = of.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("__part").alias("__p"), *[F.col(c).alias(f"__g_{c}") for c in group], "__low",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(of).alias("group_size"),
    )
    same = F.col("__part") == F.col("__p")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    return placed.join(spans, same).select(
        *df.columns, (F.col("__at") - F.col("__low") + F.col("__before")).alias(name), "group_size"
    )
