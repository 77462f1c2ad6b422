"""Table profiles: counts, column facts, top values, masked rows. One pass per kind of fact."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_ts, real_date
from ..functions.hashing import DATE_COLUMN_RE, MASKED_COLUMN_RE, mask_value, personal_columns
from ..functions.predicates import blank, placeholder


def column_rules(df: DataFrame) -> dict[str, dict[str, bool]]:
    """What a column's name says: personal, masked, date."""
    personal = set(personal_columns(df))
    return {
        c: {"personal": c in personal, "masked": bool(re.search(MASKED_COLUMN_RE, c)), "date": bool(re.search(DATE_COLUMN_RE, c))}
        for c in df.columns
    }


def _open_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    rules = column_rules(df)
    return [c for c in (columns or df.columns) if c in rules and not rules[c]["personal"]]


def table_summary(df: DataFrame, keys: Sequence[str], label: str, exact: bool = False) -> DataFrame:
    """Rows, distinct keys and possible duplicates; approximate unless asked for exact."""
    if exact:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        out = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("source_row_count"), F.count(F.lit(1)).alias("distinct_keys"))
    else:
        out = df.agg(F.count(F.lit(1)).alias("source_row_count"), F.approx_count_distinct(F.xxhash64(*keys)).alias("distinct_keys"))
    return out.select(
        F.lit(label).alias("source_table"), F.lit("|".join(keys)).alias("key_columns"), "source_row_count", "distinct_keys",
        F.greatest(F.col("source_row_count") - F.col("distinct_keys"), F.lit(0)).alias("possible_duplicates"))


def column_profile(df: DataFrame, label: str, columns: Sequence[str] | None = None, distinct: bool = True) -> DataFrame:
    """Filled, missing, placeholder, distinct, numeric, date and range facts of every column.

    One aggregate over the table, then one row per column. Distinct counts are sketches.
    """
    names = _open_columns(df, columns)
    rules, types = column_rules(df), dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("n")]
    none = F.lit(None)

    def count(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0))

    for i, c in enumerate(names):
        present = ~blank(c)
        text = F.when(present, F.col(c).cast("string"))
        aggs += [
            count(present).alias(f"filled{i}"), count(blank(c)).alias(f"missing{i}"), count(present & placeholder(c)).alias(f"placeholder{i}"),
            (F.approx_count_distinct(text) if distinct else F.max(none.cast("long"))).alias(f"distinct{i}"),
            F.count(F.trim(text).try_cast("double")).alias(f"numeric{i}"),
        ]
        if rules[c]["date"]:
            good = present & real_date(parse_ts(c))
            aggs += [count(good).alias(f"good{i}"), count(present & ~good).alias(f"bad{i}")]
        if not rules[c]["masked"]:
            aggs += [F.min(text).alias(f"min{i}"), F.max(text).alias(f"max{i}")]

    def pct(a: str, b: str) -> Column:
        return F.round(F.try_divide(F.lit(100.0) * F.col(a), F.col(b)), 6)

    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"filled{i}").alias("non_missing_count"),
            F.col(f"missing{i}").alias("missing_count"), F.col(f"placeholder{i}").alias("placeholder_count"),
            pct(f"missing{i}", "n").alias("missing_pct"), F.col(f"distinct{i}").alias("approx_distinct_count"),
            F.col(f"numeric{i}").alias("numeric_parseable_count"), pct(f"numeric{i}", f"filled{i}").alias("numeric_parseable_pct"),
            (F.col(f"good{i}") if rules[c]["date"] else none.cast("long")).alias("valid_date_count"),
            (F.col(f"bad{i}") if rules[c]["date"] else none.cast("long")).alias("invalid_date_count"),
            (F.col(f"min{i}") if not rules[c]["masked"] else none.cast("string")).alias("min_value"),
            (F.col(f"max{i}") if not rules[c]["masked"] else none.cast("string")).alias("max_value"))
        for i, c in enumerate(names)
    ])
    return df.agg(*aggs).select(F.lit(label).alias("source_table"), F.col("n").alias("profiled_row_count"), F.inline(rows))


def shown_value(c: str) -> Column:
    """Value as reported: missing and placeholder text replaced, white space collapsed."""
    return F.when(blank(c), F.lit("$NULL$")).when(placeholder(c), F.lit("$PLACEHOLDER$")).otherwise(
        F.regexp_replace(F.trim(F.col(c).cast("string")), r"\s+", " "))


def top_values(df: DataFrame, label: str, columns: Sequence[str], n: int) -> DataFrame:
    """Most frequent values per column with their share."""
    names = _open_columns(df, columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), shown_value(c).alias("sample_value")) for c in names])
    counts = df.select(F.inline(pairs)).groupBy("column_name", "sample_value").agg(F.count(F.lit(1)).alias("value_count"))
    totals = counts.groupBy("column_name").agg(F.sum("value_count").alias("_t"))
    w = Window.partitionBy("column_name").orderBy(F.col("value_count").desc(), F.col("sample_value"))
    top = counts.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= n)
    return top.join(totals, "column_name").select(
        F.lit(label).alias("source_table"), "column_name", "sample_rank", "sample_value", "value_count",
        F.round(F.lit(100.0) * F.col("value_count") / F.col("_t"), 6).alias("value_pct"))


def masked_rows(df: DataFrame, label: str, columns: Sequence[str], n: int) -> DataFrame:
    """A few distinct rows as JSON in hash order; free text and links appear as digests."""
    names = _open_columns(df, columns)
    rules = column_rules(df)
    payload = [(mask_value(c) if rules[c]["masked"] else F.col(c).cast("string")).alias(c) for c in names]
    rows = df.select(F.to_json(F.struct(*payload)).alias("row_json")).distinct()
    return rows.orderBy(F.md5("row_json"), "row_json").limit(n).select(F.lit(label).alias("source_table"), "row_json")
