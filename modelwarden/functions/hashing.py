"""Reproducible pseudo-randomness and masking built on md5 / sha2.

A bucket is the first 32 bits of an md5 text digest, so that any SQL engine can recompute it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import as_col, blank

BUCKETS = 1 << 32
NULL_KEY = "__NULL__"


def key_text(cols: Sequence[str | Column], seed: object = "") -> Column:
    """Key columns as one text; the separator and its escape cannot be forged by a value."""
    parts = [F.lit(str(seed))]
    for c in cols:
        value = F.coalesce(as_col(c).cast("string"), F.lit(NULL_KEY))
        parts.append(F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")))
    return F.concat_ws("|", *parts)


def digest(cols: Sequence[str | Column], seed: object = "") -> Column:
    """32 hex digits, uniform over rows with distinct keys."""
    return F.md5(key_text(cols, seed))


def hex_number(hex_text: Column, start: int = 1, digits: int = 8) -> Column:
    return F.conv(F.substring(hex_text, start, digits), 16, 10).cast("long")


def bucket(cols: Sequence[str | Column], seed: object = "") -> Column:
    """Integer in [0, 2**32)."""
    return hex_number(digest(cols, seed))


def unit_bucket(cols: Sequence[str | Column], seed: object = "") -> Column:
    """Double in [0, 1)."""
    return bucket(cols, seed) / F.lit(float(BUCKETS))


def pseudonymise(cols: Sequence[str | Column]) -> Column:
    """Stable 64-bit key for a person, as text."""
    values = [F.coalesce(as_col(c).cast("string"), F.lit("$NULL$")) for c in cols]
    return F.xxhash64(*values).cast("string")


def pseudonymise_sha(cols: Sequence[str | Column]) -> Column:
    """Same purpose, recomputable outside Spark: 16 hex digits of sha-256."""
    return F.substring(F.sha2(key_text([F.coalesce(as_col(c).cast("string"), F.lit("$NULL$")) for c in cols]), 256), 1, 16)


def mask_value(c: str | Column) -> Column:
    """``sha256:`` digest of the trimmed text; blank stays NULL."""
    return F.when(
        ~blank(c), F.concat(F.lit("sha256:"), F.sha2(F.trim(as_col(c).cast("string")), 256))
    )


# --- fixed values: which column names carry personal or free-text content ---
PERSONAL_COLUMN_RE = r"(?i)(^|_)(usr|user|cont|contact|lead|tlds|cds)(_|$)"
MASKED_COLUMN_RE = (
    r"(?i)(link|path|repstry|repository|dataset|cmnt|comment|descr|_txt$|ent_param_chg_(prev_)?val$)"
)
DATE_COLUMN_RE = r"(?i)(_dt|_dttm|_date)$"
# ----------------------------------------------------------------------------


def personal_columns(df: DataFrame) -> list[str]:
    import re

    return [c for c in df.columns if re.search(PERSONAL_COLUMN_RE, c)]


def drop_personal_columns(df: DataFrame) -> DataFrame:
    """Exclude columns whose name marks personal data; checked again on the output."""
    out = df.drop(*personal_columns(df))
    if personal_columns(out):
        raise ValueError(f"personal columns left: {personal_columns(out)}")
    return out
