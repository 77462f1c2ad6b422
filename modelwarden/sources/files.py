"""File scans and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One file, a directory tree, or a glob; nothing to read is an error."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        return spark.read.option("recursiveFileLookup", True).parquet(*paths)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no parquet input under {paths}") from exc


def scan_csv(spark: SparkSession, path: str, schema: str | T.StructType, **options: object) -> DataFrame:
    """CSV with a given schema; options pass through to the reader."""
    settings = {"header": True, **options}
    return spark.read.schema(schema).options(**settings).csv(path)


TRIAL_SCHEMA = (
    "fidelity string, method string, subset array<string>, n_features int, valid_metric double, "
    "train_metric double, gap double, metric_std double, constraint_violation double, "
    "runtime_seconds double, metrics map<string,double>"
)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType = TRIAL_SCHEMA) -> DataFrame:
    """Append-only log: torn lines and lines that are no JSON object are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def parquet_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows, bytes and columns below a path, from file metadata and row counts."""
    df = scan_parquet(spark, path)
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").alias("rows"),
        F.sum("file_size").alias("bytes"),
        F.lit(len(df.columns)).alias("columns"),
    )


def write_parquet(df: DataFrame, path: str, overwrite: bool = False, compression: str = "zstd",
                  partition_by: Sequence[str] = ()) -> None:
    """Refuses a target that exists unless told to overwrite it."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_results(summary: DataFrame, detail: DataFrame, path: str) -> None:
    """Summary and detail; detail clustered by control so that one control is cheap to read.

    The range is over the control and the entity, so a control with most of the rows still
    spreads over several files. The number of files follows the data (shuffle partitions).
    """
    summary.write.mode("overwrite").parquet(f"{path}/summary")
    (
        detail.repartitionByRange("query_id", "source_entity_sid")
        .sortWithinPartitions("query_id")
        .write.mode("overwrite").parquet(f"{path}/detail")
    )


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def flat_text(df: DataFrame) -> DataFrame:
    """Complex columns as JSON text, dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(f.name).alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def export_limited(df: DataFrame, max_rows: int) -> DataFrame:
    """Export form of a report; more rows than the consumer can hold is an error."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows; write Parquet instead")
    return flat_text(df)


def export_in_parts(df: DataFrame, path: str, rows_per_file: int) -> None:
    """The whole report in export form, cut into CSV files that a consumer can hold; no row is left out and nothing is counted first."""
    flat_text(df).write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", rows_per_file).csv(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir; local sessions without it get a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the statements inside are deleted as each ends; otherwise they lie on disk until the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
