"""Walk a catalogue, one status row per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from .contract import literal_rows


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted({t.name.lower() for t in spark.catalog.listTables(database)})


def table_status(spark: SparkSession, readers: Mapping[str, Callable[[], DataFrame]],
                 inspect: Callable[[DataFrame], object] = lambda df: df.schema) -> DataFrame:
    """Try each table; a failing one becomes an ERROR row and the walk goes on."""
    rows = []
    for name in sorted(readers):
        try:
            inspect(readers[name]())
            rows.append((name, "OK", None))
        except Exception as exc:  # noqa: BLE001 - the report is about any failure
            rows.append((name, "ERROR", f"{type(exc).__name__}: {str(exc)[:500]}"))
    return literal_rows(spark, rows, "table_name string,status string,error string")
