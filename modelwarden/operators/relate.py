"""Joins and set operations of the registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import required


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).dropna().distinct()


def left_with_defaults(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                       defaults: Mapping[str, object]) -> DataFrame:
    """Left join, then fill the right side's gaps."""
    return left.join(right, on, "left").fillna(dict(defaults))


def full_with_priority(first: DataFrame, second: DataFrame, on: str, name: str,
                       first_col: str, second_col: str) -> DataFrame:
    """Full join; the first source wins where it holds something usable."""
    return first.join(second, on, "full").select(
        on,
        F.coalesce(
            F.when(required(first_col), F.col(first_col)),
            F.when(required(second_col), F.col(second_col)),
        ).alias(name),
    )


def within(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Semi join: rows whose key is in the key frame."""
    return df.join(keys, on, "left_semi")


def outside(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Anti join: rows whose key is not in the key frame."""
    return df.join(keys, on, "left_anti")


def join_where(left: DataFrame, right: DataFrame, left_key: str, right_key: str, residual: Column) -> DataFrame:
    """Equi join with a further condition on the pair."""
    return left.join(right, (F.col(left_key) == F.col(right_key)) & residual, "inner")


def without_children(parent: DataFrame, child: DataFrame, on: str) -> DataFrame:
    """Add ``has_child``: 0 where no child row carries the key."""
    keys = distinct_keys(child, [on]).withColumn("has_child", F.lit(1))
    return parent.join(keys, on, "left").fillna({"has_child": 0})


def marker(df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """Distinct keys meeting a condition, with a constant 1."""
    return df.filter(condition).select(key).distinct().withColumn(name, F.lit(1))


def presence_flag(df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """1 when any row of the key meets the condition, else 0."""
    return df.groupBy(key).agg(F.max(F.when(condition, 1).otherwise(0)).alias(name))


def resolve_parent(child: DataFrame, bridge: DataFrame, via: str, key: str, name: str) -> DataFrame:
    """Own parent key, else the parent of the linked bridge row."""
    link = bridge.select(F.col(via), F.col(key).alias("_via_key"))
    return child.join(link, via, "left").withColumn(name, F.coalesce(F.col(key), F.col("_via_key"))).drop("_via_key")


def union_named(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def first_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; the smallest remaining columns win."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def key_overlap(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Number of distinct keys present on both sides, as one row."""
    return distinct_keys(left, on).join(distinct_keys(right, on), list(on), "left_semi").agg(
        F.count(F.lit(1)).alias("shared_keys")
    )


def key_closure(seeds: DataFrame, hops: Sequence[tuple[str, DataFrame, str, str, str]],
                kind: str, hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Follow a fixed list of hops from a set of seed keys.

    A hop is ``(from_kind, table, from_column, to_column, to_kind)``. The result lists every
    reached key once as ``(kind, key)``; the keys stay distributed throughout. ``hold`` keeps each
    frontier (a written table or a checkpoint), so that a hop reads what the hops before have found
    and does not find it again.
    """
    reached: dict[str, DataFrame] = {kind: seeds.select(F.col(seeds.columns[0]).cast("string").alias("key")).distinct()}
    for source, table, from_col, to_col, target in hops:
        if source not in reached:
            raise ValueError(f"hop from {source} before it is reached")
        step = table.select(F.col(from_col).cast("string").alias("key"), F.col(to_col).cast("string").alias("_to"))
        found = (
            step.join(reached[source], "key", "left_semi").filter(F.col("_to").isNotNull())
            .select(F.col("_to").alias("key")).distinct()
        )
        if target in reached:  # only new keys go on
            found = reached[target].union(hold(found.join(reached[target], "key", "left_anti")))
        reached[target] = found if target in reached else hold(found)
    return union_named(*[df.select(F.lit(k).alias("kind"), "key") for k, df in reached.items()])


def scope_index(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], kinds: Mapping[str, str]) -> DataFrame:
    """(table_name, row_key, kind, key): every key cell of all tables, each table read once. ``kinds``: column to kind."""
    parts = []
    for name, (df, row_key) in tables.items():
        used = {c: k for c, k in kinds.items() if c in df.columns}
        if used:
            pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("key")) for c, k in used.items()])
            row = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in row_key]))
            parts.append(df.select(F.lit(name).alias("table_name"), row.alias("row_key"), F.inline(pairs)).filter(F.col("key").isNotNull()))
    return union_named(*parts)


def scoped_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], closure: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Rows of each table tied to the closure: one semi-join for all tables."""
    hits = scope_index(tables, kinds).join(closure, ["kind", "key"], "left_semi")
    return hits.select("table_name", "row_key").distinct().groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def in_scope(df: DataFrame, closure: DataFrame, columns: Mapping[str, str], row_key: Sequence[str]) -> DataFrame:
    """Rows matching the closure through any of their key columns (column -> kind).

    Each row's keys are unpivoted and semi-joined once, so several key columns need one join
    instead of a disjunction.
    """
    pairs = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("key")) for c, kind in columns.items()
    ])
    hits = (
        df.select(*row_key, F.explode(pairs).alias("_p")).select(*row_key, "_p.kind", "_p.key")
        .filter(F.col("key").isNotNull())
        .join(closure, ["kind", "key"], "left_semi").select(*row_key).distinct()
    )
    return df.join(hits, list(row_key), "left_semi")
