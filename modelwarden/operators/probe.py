"""Search the tables of a mart for everything tied to a set of keys."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import EMPTY_TEXT, LINK_COLUMN_RE, link_column, link_value
from ..sources.contract import literal_rows
from .measures import top_per_group
from .relate import in_scope, scoped_counts

SERVICE_TEXT = (*EMPTY_TEXT, "$not_applicable$")


def to_long(df: DataFrame, table: str) -> DataFrame:
    """(table, column, value) for every non-empty cell."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
    return df.select(F.lit(table).alias("table_name"), F.inline(pairs)).filter(F.trim("value") != "")


def first_values(long: DataFrame, n: int) -> DataFrame:
    """First n distinct values per column in text order."""
    keys = ["table_name", "column_name"]
    return top_per_group(long.select(*keys, "value").distinct(), keys, [F.col("value")], n, "value_no")


def _meaningful(c: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(c)).isin(*SERVICE_TEXT), F.lit(False))


def link_hits(long: DataFrame, n: int = 100) -> DataFrame:
    """Values that look like links, or sit in a link-like column, at most n per column."""
    hit = link_value("value") | (link_column(F.col("column_name")) & _meaningful(F.col("value")))
    keys = ["table_name", "column_name"]
    return top_per_group(long.filter(hit).select(*keys, "value").distinct(), keys, [F.col("value")], n, "hit_no")


def link_rows(df: DataFrame, table: str, order: Sequence[str] = (), n: int | None = None) -> DataFrame:
    """Whole rows that hold a link, as JSON text: all of them, or the first n in the given order."""
    cond = F.lit(False)
    for c in df.columns:
        text = F.col(c).cast("string")
        cond = cond | link_value(text)
        if re.search(LINK_COLUMN_RE, c):
            cond = cond | _meaningful(text)
    hits = df.filter(cond)
    if n is not None:
        hits = hits.orderBy(*order).limit(n)
    return hits.select(F.lit(table).alias("table_name"), F.to_json(F.struct(*df.columns)).alias("row_json"))


def scoped_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], closure: DataFrame, kinds: Mapping[str, str]) -> dict[str, DataFrame]:
    """Rows of each table tied to the closure; tables without a known key column are left out."""
    out = {}
    for name, (df, row_key) in tables.items():
        used = {c: k for c, k in kinds.items() if c in df.columns}
        if used:
            out[name] = in_scope(df, closure, used, row_key)
    return out


def coverage(spark, tables: Mapping[str, tuple[DataFrame, Sequence[str]]], closure: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """OK / NO_MATCH / NO_RELATION_KEY / ERROR per table, from one index of all tables.

    ERROR is a table that cannot be resolved; a failure while reading stops the job.
    """
    rows, sound = [], {}
    for name in sorted(tables):
        df, row_key = tables[name]
        try:
            used = [c for c in kinds if c in df.columns]
            df.select(*row_key, *used)
            sound[name] = (df, row_key)
            rows.append((name, ", ".join(used), None))
        except Exception as exc:  # noqa: BLE001 - one bad table must not stop the walk
            rows.append((name, "", f"{type(exc).__name__}: {str(exc)[:500]}"))
    known = literal_rows(spark, rows, "table_name string,relation_keys string,error string")
    found = scoped_counts(sound, closure, kinds).withColumnRenamed("table_name", "_t")
    status = F.when(F.col("error").isNotNull(), "ERROR").when(F.col("relation_keys") == "", "NO_RELATION_KEY").when(F.col("rows").isNotNull(), "OK").otherwise("NO_MATCH")
    return known.join(found, F.col("table_name") == F.col("_t"), "left").select("table_name", status.alias("status"), "relation_keys", "error")
