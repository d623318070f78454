"""Partitions by a monotone transform of a column, and the conditions that prune them.

A table may be partitioned by the day of a timestamp that readers never name. A range condition on the timestamp
then implies one on the day, since a later timestamp never has an earlier day. ``Ranged`` holds both: the
condition on the rows and what it implies for the partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ranged:
    """A condition on a column, and the weaker one that it implies for the partition column."""

    rows: Column
    partitions: Column

    def __and__(self, other: Ranged) -> Ranged:
        return Ranged(self.rows & other.rows, self.partitions & other.partitions)

    def __or__(self, other: Ranged) -> Ranged:
        return Ranged(self.rows | other.rows, self.partitions | other.partitions)


@dataclass(frozen=True)
class Transform:
    """``partition`` is ``apply`` of ``source``, which never falls where ``source`` rises."""

    source: str
    partition: str
    apply: Callable[[Column], Column]

    def added(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition, self.apply(F.col(self.source)))

    def _bound(self, value) -> Column:
        return self.apply(F.lit(value))

    def at_least(self, value) -> Ranged:
        return Ranged(F.col(self.source) >= F.lit(value), F.col(self.partition) >= self._bound(value))

    def above(self, value) -> Ranged:
        return Ranged(F.col(self.source) > F.lit(value), F.col(self.partition) >= self._bound(value))

    def at_most(self, value) -> Ranged:
        return Ranged(F.col(self.source) <= F.lit(value), F.col(self.partition) <= self._bound(value))

    def below(self, value) -> Ranged:
        return Ranged(F.col(self.source) < F.lit(value), F.col(self.partition) <= self._bound(value))

    def equal(self, value) -> Ranged:
        return Ranged(F.col(self.source) == F.lit(value), F.col(self.partition) == self._bound(value))

    def within(self, low, high) -> Ranged:
        """From ``low`` to before ``high``."""
        return self.at_least(low) & self.below(high)


def days(source: str, partition: str = "partition_date") -> Transform:
    return Transform(source, partition, F.to_date)


def months(source: str, partition: str = "partition_month") -> Transform:
    """Months as their first day."""
    return Transform(source, partition, lambda c: F.trunc(c, "month"))


def steps(source: str, width: int, partition: str = "partition_step") -> Transform:
    """Whole numbers in steps of ``width``."""
    return Transform(source, partition, lambda c: F.floor(c / F.lit(width)).cast("long"))
