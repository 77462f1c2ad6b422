"""Feature universe, type inference and preparation decided on the training part."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import TIMESTAMP_FORMATS
from ..sources.contract import literal_rows, schema_agreement

MISSING_LEVEL = "__MISSING__"
# --- fixed values: the shape of a date in text --------------------------------------
DATE_SHAPES = (
    r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}([ T].*)?$",
    r"^\d{1,2}[./-]\d{1,2}[./-]\d{4}([ T].*)?$",
    r"^\d{8}$",
)
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy", "yyyy/MM/dd", "yyyyMMdd", *TIMESTAMP_FORMATS[:1])
PATTERN_RATE, PARSE_RATE = 0.8, 0.9
# --------------------------------------------------------------------------------------


def feature_universe(df: DataFrame, control: Sequence[str], required: Sequence[str] = (), categorical: Sequence[str] = ()) -> list[str]:
    """Columns that are not control columns; required or categorical names must be among them."""
    features = [c for c in df.columns if c not in set(control)]
    lost = sorted((set(required) | set(categorical)) - set(features))
    if lost:
        raise ValueError(f"not among the features: {lost}")
    return features


def _is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def infer_categorical(df: DataFrame, features: Sequence[str], explicit: Sequence[str] = (), integers_up_to: int = 0) -> list[str]:
    """Text and boolean features, and on request integers with few distinct values."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cats = {f for f in features if isinstance(types[f], (T.StringType, T.BooleanType))} | (set(explicit) & set(features))
    ints = [f for f in features if isinstance(types[f], T.IntegralType) and f not in cats]
    if integers_up_to and ints:
        row = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in ints]).first()
        cats |= {c for c in ints if row[c] <= integers_up_to}
    return sorted(cats)


def date_text_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: share shaped like a date, share each format parses, best format, verdict.

    One aggregate reads every column under every format.
    """
    aggs = []
    for i, c in enumerate(columns):
        t = F.trim(F.col(c).cast("string"))
        shaped = F.lit(False)
        for p in DATE_SHAPES:
            shaped = shaped | t.rlike(p)
        aggs += [F.count(t).alias(f"n{i}"), F.sum(shaped.cast("long")).alias(f"s{i}")]
        aggs += [F.count(F.try_to_timestamp(t, F.lit(f))).alias(f"f{i}_{j}") for j, f in enumerate(DATE_FORMATS)]
    best = []
    for i, c in enumerate(columns):
        counts = [F.col(f"f{i}_{j}") for j in range(len(DATE_FORMATS))]
        top = F.greatest(*counts)
        name = F.lit(DATE_FORMATS[-1])
        for j in range(len(DATE_FORMATS) - 2, -1, -1):
            name = F.when(counts[j] == top, F.lit(DATE_FORMATS[j])).otherwise(name)
        best.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("values"),
            F.try_divide(F.col(f"s{i}"), F.col(f"n{i}")).alias("pattern_rate"),
            F.try_divide(top, F.col(f"n{i}")).alias("parse_rate"), name.alias("best_format")))
    out = df.agg(*aggs).select(F.inline(F.array(*best)))
    is_date = (F.col("pattern_rate") >= PATTERN_RATE) & (F.col("parse_rate") >= PARSE_RATE)
    return out.withColumn("is_date", F.coalesce(is_date, F.lit(False)))


def type_audit(frames: Mapping[str, DataFrame], features: Sequence[str], dates: Sequence[str] = (), reference: str = "train") -> DataFrame:
    """What will be done with each feature, with its type in every part."""
    types = {r: {f.name: f.dataType for f in df.schema.fields} for r, df in frames.items()}
    rows = []
    for c in features:
        t = types[reference][c]
        if c in dates or isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            action = "EXPAND_DATETIME"
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            action = "ERROR_COMPLEX_OBJECT"
        elif _is_numeric(t):
            action = "NUMERIC"
        elif isinstance(t, (T.StringType, T.BooleanType)):
            action = "CATEGORICAL"
        else:
            action = "UNSUPPORTED_DTYPE"
        seen = ";".join(f"{r}={types[r][c].simpleString() if c in types[r] else 'absent'}" for r in frames)
        rows.append((c, action, seen))
    return literal_rows(frames[reference].sparkSession, rows, "feature string,action string,types string")


def constant_features(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """KEEP or DROP per feature: constant on train counting a missing value as a value.

    Minimum, maximum and missing flag decide it, so nothing is collected or shuffled per value.
    """
    types = dict(train.dtypes)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(features):
        v = F.to_json(c) if types[c].startswith(("array", "map", "struct")) else F.col(c)
        aggs += [F.min(v).cast("string").alias(f"a{i}"), F.max(v).cast("string").alias(f"b{i}"), F.count(v).alias(f"c{i}")]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.when((F.col(f"c{i}") == 0) | ((F.col(f"c{i}") == F.col("n")) & (F.col(f"a{i}") == F.col(f"b{i}"))), F.lit("DROP_CONSTANT_TRAIN"))
            .otherwise(F.lit("KEEP")).alias("status"))
        for i, c in enumerate(features)
    ])
    return train.agg(*aggs).select(F.inline(rows))


def column_agreement(frames: Mapping[str, DataFrame], reference: str = "train", columns: Sequence[str] | None = None) -> DataFrame:
    """Columns of the training part that are missing or typed differently in another part."""
    return schema_agreement(frames, reference, columns)


def clean_infinite(df: DataFrame) -> DataFrame:
    """Plus and minus infinity become NULL in floating columns."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    inf = F.lit(float("inf"))
    return df.withColumns({c: F.when(F.abs(F.col(c)) != inf, F.col(c)) for c in cols})


def categorical_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per categorical column (what the ``error`` strategy reports)."""
    sums = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c) for c in columns])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])))


def fill_categorical(df: DataFrame, columns: Sequence[str], strategy: str = "fill", value: str = MISSING_LEVEL) -> DataFrame:
    """Categories as text; gaps become a level of their own, or are an error."""
    if strategy == "error":
        bad = categorical_nulls(df, columns).filter("null_count > 0").collect()
        if bad:
            raise ValueError(f"missing categories: {[(r.column_name, r.null_count) for r in bad]}")
    elif strategy != "fill":
        raise ValueError("strategy: fill or error")
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in columns})


def binary_target(df: DataFrame, target: str, positive: object, name: str = "y", check: bool = True) -> DataFrame:
    """0/1 target; anything but two non-missing classes is an error."""
    if check:
        seen = df.select(target).distinct().limit(3).collect()
        values = [r[0] for r in seen]
        if None in values or len(values) != 2 or positive not in values:
            raise ValueError(f"target needs two non-null classes including {positive!r}: {values}")
    return df.withColumn(name, (F.col(target) == positive).cast("int"))


def unpivot(df: DataFrame, keep: Sequence[str | Column], columns: Sequence[str], as_type: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(as_type).alias("value")) for c in columns])
    return df.select(*keep, F.inline(pairs))
