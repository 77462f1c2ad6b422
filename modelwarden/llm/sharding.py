"""Two-pass external shuffle into shards.

Pass one scatters rows uniformly over buckets that fit in memory, by a seeded hash. Pass two holds one bucket at a
time, shuffles it by Fisher-Yates and writes it. Buckets laid end to end form one random order of all rows; shards are
equal ranges of that order, so their row counts differ by one at most (law `rows`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwarden.llm.common import shared_folder, stored


def fisher_yates(count: int, seed: int) -> np.ndarray:
    """A uniform random order of 0..count-1: each place from the last swaps with one at or before it."""
    rng = np.random.Generator(np.random.PCG64(seed))
    order = list(range(count))
    picks = (rng.random(count) * np.arange(1, count + 1)).astype(np.int64).tolist()
    for i in range(count - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def bucket_starts(counts: DataFrame, block: int = 4096) -> DataFrame:
    """Adds to rows (bucket, n) the number of rows in all buckets before: sums by block first, then inside blocks."""
    counts = counts.withColumn("block", F.floor(F.col("bucket") / block))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("m"))
    ahead = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(blocks, "block").select(
        "bucket", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first_place")
    )


def shuffle_to_shards(
    df: DataFrame, shards: int, seed: int = 0, key: tuple[str, ...] = ("doc_id", "text"), size: str = "text",
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """The rows of `df` with `shard` (0 to shards-1) and `slot` (gapless from 0 in each shard).

    * Buckets: a seeded hash of the `key` columns; their number follows the bytes of column `size`, so that a bucket
      has about `bucket_bytes`. Copies of one text with different ids spread over all buckets. Rows equal in all key
      columns share a bucket; null keys are hashed as they are.
    * The order depends on seed and rows only: a bucket is put in hash order before it is shuffled, so a task that
      runs again after a lost executor gives the same rows. Rows equal in every key column may swap places.
    * An empty table gives no rows. Columns named shard or slot are replaced.
    """
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    hashed = F.xxhash64(F.lit(seed), *key)
    bulk = df.agg(F.sum(F.coalesce(F.octet_length(size), F.lit(0)) + F.lit(64)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    rows, buckets = bulk["n"], max(1, -(-(bulk["b"] or 0) // bucket_bytes))
    of = F.pmod(hashed, F.lit(buckets))
    # A stored table of known size: Spark broadcasts it or shuffles by bucket, and then the grouping needs no further shuffle.
    starts = stored(bucket_starts(df.groupBy(of.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))), "starts")
    scattered = df.select(*columns, of.alias("__bucket"), hashed.alias("__hash"))
    placed = scattered.join(starts.withColumnRenamed("bucket", "__bucket"), "__bucket")

    def run(bucket: pa.Table) -> pa.Table:
        inside = np.lexsort((np.arange(bucket.num_rows), bucket["__hash"].to_numpy()))
        order = inside[fisher_yates(bucket.num_rows, (int(bucket["__bucket"][0].as_py()) << 32) + (seed & 0xFFFFFFFF))]
        place = bucket["first_place"][0].as_py() + np.arange(bucket.num_rows, dtype=np.int64)
        # shard s holds the places from ceil(s * rows / shards) on
        shard = place * shards // rows
        slot = place - -(-shard * rows // shards)
        out = bucket.select(columns).take(pa.array(order))
        return out.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot, pa.int64()))

    schema = T.StructType([*(df.schema[c] for c in columns), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return placed.groupBy("__bucket").applyInArrow(run, schema)


def write_shards(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes rows with `shard` and `slot` as Parquet, one folder a shard, in slot order within a file; reads them back."""
    path = path or f"{shared_folder(df.sparkSession)}/shards"
    df.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    schema = T.StructType([f for f in df.schema if f.name != "shard"] + [T.StructField("shard", T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)
