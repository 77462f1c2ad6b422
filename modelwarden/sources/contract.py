"""Schema contracts: what a table must offer before an operator reads it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small driver-side list (rule catalogue, schema diff) as a JVM-side frame."""
    names = [part.split()[0] for part in schema.split(",")]
    types = [part.split(None, 1)[1] for part in schema.split(",")]
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def contract_gaps(df: DataFrame, required: Iterable[str]) -> dict[str, list[str]]:
    """Names that are missing, and names that differ only by case."""
    low = [c.lower() for c in df.columns]
    return {
        "missing": sorted({r.lower() for r in required} - set(low)),
        "ambiguous": sorted({c for c in low if low.count(c) > 1}),
    }


def apply_contract(df: DataFrame, required: Iterable[str], label: str = "table") -> DataFrame:
    """Lower-case names; ambiguous or missing names are errors."""
    gaps = contract_gaps(df, required)
    if gaps["ambiguous"]:
        raise ValueError(f"{label}: ambiguous column names {gaps['ambiguous']}")
    if gaps["missing"]:
        raise ValueError(f"{label}: missing columns {gaps['missing']}")
    return df.toDF(*[c.lower() for c in df.columns])


def read_contract(spark: SparkSession, table: str, required: Iterable[str]) -> DataFrame:
    """A catalogue table checked against its required columns."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table not found: {table}")
    return apply_contract(spark.table(table), required, table)


def contract_report(spark: SparkSession, frames: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per required column that is absent, and one per absent table."""
    rows = []
    for table, columns in required.items():
        if table not in frames:
            rows.append((table, "TABLE_MISSING", None))
            continue
        rows += [(table, "SCHEMA_MISSING", c) for c in contract_gaps(frames[table], columns)["missing"]]
    return literal_rows(spark, rows, "source_table string,record_type string,column_name string")


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that exist; an empty frame when none does."""
    have = [c for c in cols if c in df.columns]
    return df.select(*have) if have else df.limit(0)


def schema_agreement(frames: Mapping[str, DataFrame], reference: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns of the reference frame that are missing or typed differently elsewhere."""
    base = dict(frames[reference].dtypes)
    names = list(columns) if columns is not None else list(base)
    rows = []
    for role, df in frames.items():
        if role == reference:
            continue
        other = dict(df.dtypes)
        for c in names:
            if other.get(c) != base.get(c):
                rows.append((role, c, base.get(c), other.get(c)))
    spark = frames[reference].sparkSession
    return literal_rows(
        spark, rows, "role string,column_name string,reference_type string,actual_type string"
    )
