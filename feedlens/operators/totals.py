"""Rows at each stage of a job, counted by the action that the job runs anyway."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(seen: Observation, names: list[str]) -> dict[str, int]:
    """The observed counts; a plan that turns out empty while it runs leaves none, which counts as 0."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return {name: found.get(name) or 0 for name in names}


class StageTotals:
    """``watch`` each stage, run one action, then read ``counts``. Makes no job of its own.

    Where a task ran again or a later stage reads an earlier one several times,
    each reading counts the same rows, and one of them is reported.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, stage: str) -> DataFrame:
        if stage in self._seen:
            raise ValueError(f"stage {stage} is watched already")
        self._seen[stage] = Observation(f"{stage}-{uuid.uuid4().hex}")
        return rows.observe(self._seen[stage], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """Rows per stage, in the order in which they were watched; waits for the action."""
        return {stage: observed(seen, ["rows"])["rows"] for stage, seen in self._seen.items()}
