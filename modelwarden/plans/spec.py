"""Controls as data: what a rule reads, when it applies, what counts as an issue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column


@dataclass(frozen=True)
class Control:
    """One rule over the rows of a named base frame.

    One row of the base is one applicable entity when ``applies`` holds. ``entity`` and
    ``entity_sid`` name the offending thing in the detail; ``issue_name`` may be a Column.
    """

    id: int
    name: str
    domain: str
    severity: str
    base: str
    applies: Column
    issue: Column
    dim_1: tuple[str, Column]
    dim_2: tuple[str, Column]
    issue_name: str | Column
    empty_reason: str
    entity: str = "MODEL_VER"
    entity_sid: str | Column = "model_ver_sid"
    version: str | Column = "model_ver_sid"
