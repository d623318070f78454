"""Counts taken while rows are written, instead of by a second pass over what was written.

The counts are observed at the top of the plan, in the stage whose tasks write: each task's count is taken once,
when it succeeds, however often a task or an earlier stage was repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowloom.operators.changes import COMMON, DELETED, NEW, REJECTED, UPDATED


class Counting(NamedTuple):
    """Rows to be written, and what is counted while they are."""

    rows: DataFrame
    observation: Observation

    def totals(self) -> dict[str, int]:
        """The counts of the write. Waits until the first action on ``rows`` has ended."""
        return dict(self.observation.get)


def counting(rows: DataFrame, totals: Mapping[str, Column] | None = None) -> Counting:
    """``rows`` that are counted (``n_rows``) when they are written, with further aggregates in ``totals``."""
    observation = Observation()
    aggregates = {"n_rows": F.count(F.lit(1))} | dict(totals or {})
    return Counting(rows.observe(observation, *(a.alias(name) for name, a in aggregates.items())), observation)


def counting_by(rows: DataFrame, column: str, values: Mapping[str, object]) -> Counting:
    """``rows`` counted by the values of a column: name of the count, and value."""
    return counting(rows, {name: F.count_if(F.col(column).eqNullSafe(F.lit(v))) for name, v in values.items()})


def counting_changes(classified: DataFrame) -> Counting:
    """Classified rows (``classify_changes``) that give their control total when they are written.

    As every input row is in exactly one classified row, the rows of both inputs follow from the classes.
    """
    status, rejected = F.col("status"), F.col("status") == REJECTED
    # Output column per measure.
    return counting(
        classified,
        {
            "master_rows": F.count_if(F.col("m").isNotNull()),
            "delta_rows": F.count_if(F.col("d").isNotNull()),
            "common_rows": F.count_if(status == COMMON),
            "new_rows": F.count_if(status == NEW),
            "updated_rows": F.count_if(status == UPDATED),
            "deleted_rows": F.count_if(status == DELETED),
            "rejected_master_rows": F.count_if(rejected & F.col("m").isNotNull()),
            "rejected_delta_rows": F.count_if(rejected & F.col("d").isNotNull()),
        },
    )
