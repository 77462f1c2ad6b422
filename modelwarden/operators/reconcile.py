"""Compare a report with an independent recomputation, and check a report's own invariants."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import required


def key_coverage(report: DataFrame, control: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has."""
    r, c = report.select(key).distinct(), control.select(key).distinct()
    return c.join(r, key, "left_anti").withColumn("problem", F.lit("MISSING_FROM_REPORT")).unionByName(
        r.join(c, key, "left_anti").withColumn("problem", F.lit("UNEXPECTED_IN_REPORT")))


def cell_mismatches(report: DataFrame, control: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per differing cell; NULL equals NULL."""
    left = report.select(key, *[F.col(c).cast("string").alias(f"r_{c}") for c in columns])
    right = control.select(key, *[F.col(c).cast("string").alias(f"c_{c}") for c in columns])
    cells = F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.col(f"r_{c}").alias("actual"), F.col(f"c_{c}").alias("expected")) for c in columns
    ])
    return left.join(right, key).select(key, F.inline(cells)).filter(~F.col("actual").eqNullSafe(F.col("expected")))


def distribution(report: DataFrame, control: DataFrame, column: str) -> DataFrame:
    """Rows per category on both sides."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("<NULL>")).alias("category")).agg(F.count(F.lit(1)).alias(name))

    return counts(report, "report_count").join(counts(control, "control_count"), "category", "full").fillna(0, ["report_count", "control_count"])


def verdict(report: DataFrame, control: DataFrame, key: str, columns: Sequence[str], category: str) -> DataFrame:
    """One row of counts and OK or FAILED, from one full join. Keys are unique on each side."""
    need = list(dict.fromkeys([*columns, category]))

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(F.col(key).alias(f"{p}_key"), *[F.col(c).cast("string").alias(f"{p}_{c}") for c in need])

    pairs = side(report, "r").join(side(control, "c"), F.col("r_key") == F.col("c_key"), "full")
    in_r, in_c = F.col("r_key").isNotNull(), F.col("c_key").isNotNull()
    differing = reduce(lambda a, b: a + b, [(~F.col(f"r_{c}").eqNullSafe(F.col(f"c_{c}"))).cast("long") for c in columns])

    def total(c, name):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)

    counts = pairs.agg(
        F.count("r_key").alias("report_rows"), F.count("c_key").alias("control_rows"),
        total((~in_r).cast("long"), "missing_from_report"), total((~in_c).cast("long"), "unexpected_in_report"),
        total(F.when(in_r & in_c, differing), "cell_mismatches"),
    )
    per_category = pairs.select(F.inline(F.array(
        F.struct(F.coalesce(f"r_{category}", F.lit("<NULL>")).alias("category"), in_r.cast("long").alias("r"), F.lit(0).cast("long").alias("c")),
        F.struct(F.coalesce(f"c_{category}", F.lit("<NULL>")).alias("category"), F.lit(0).cast("long").alias("r"), in_c.cast("long").alias("c")),
    ))).groupBy("category").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    off = per_category.filter("r <> c").agg(F.count(F.lit(1)).alias("distribution_mismatches"))
    row = counts.crossJoin(F.broadcast(off))  # two one-row frames
    failed = (F.col("report_rows") != F.col("control_rows")) | (
        F.col("missing_from_report") + F.col("unexpected_in_report") + F.col("cell_mismatches") + F.col("distribution_mismatches") > 0)
    return row.withColumn("status", F.when(failed, F.lit("FAILED")).otherwise(F.lit("OK")))


def report_invariants(report: DataFrame, key: str, flags: Sequence[str], total: str) -> DataFrame:
    """Broken rules of a flag report with their row counts."""
    bad_flag = reduce(lambda a, b: a | b, [F.coalesce(~F.col(f).isin(0, 1), F.lit(True)) for f in flags])
    total_off = F.coalesce(F.col(total) != reduce(lambda a, b: a + b, [F.col(f) for f in flags]), F.lit(True))
    row_rules = {"BLANK_KEY": ~required(key), "FLAG_NOT_0_1": bad_flag, "TOTAL_NOT_SUM_OF_FLAGS": total_off}
    per_row = report.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in row_rules.items()]).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("invariant"), F.col(n).alias("rows")) for n in row_rules])))
    repeated = report.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit("DUPLICATE_KEY").alias("invariant"), "rows")
    return per_row.unionByName(repeated)


def assert_report(report: DataFrame, key: str, flags: Sequence[str], total: str) -> DataFrame:
    broken = report_invariants(report, key, flags, total).filter("rows > 0").collect()
    if broken:
        raise ValueError(f"report breaks {[(r.invariant, r.rows) for r in broken]}")
    return report
