"""Limits that a run must keep, measured by the layer writes themselves.

The counts are ``DataFrame.observe`` metrics of the jobs that write a layer, so
no row is read a second time for them.  A run that breaks a limit stops with
``GateClosed``: rejects are counted while the tagged records are written, before
any layer changes; keys and references while the fact is written to a folder
that nothing refers to yet (an isolated warehouse), before its days are switched.

A task that is run again may be counted again, so a count can be too high after
a lost executor, never too low: a gate closes once too often rather than too late.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class GateClosed(ValueError):
    """A run broke one of its limits; nothing behind the gate was changed."""


@dataclass(frozen=True)
class Gates:
    """Largest allowed values; None: not looked at."""
    reject_share: float | None = None       # rejected records of a lenient run, of all records
    duplicate_keys: int | None = None       # merge keys that stand in the source with several committer ids
    orphans: int | None = None              # fact rows whose date or hour is not in its dimension

    def on_fact(self) -> bool:
        return self.duplicate_keys is not None or self.orphans is not None


def several_ids() -> Column:
    """Whether a group of staging rows has more than one committer_id, NULL counted as one: the
    loader's grain then holds its merge key more than once."""
    named = F.count("committer_id")
    return (F.min("committer_id") < F.max("committer_id")) | ((named > 0) & (named < F.count(F.lit(1))))


class Watch:
    """Named counts of a DataFrame, known once a job over it has ended."""

    def __init__(self, **counted: Column):
        self._seen, self._counted = Observation(), counted

    def over(self, rows: DataFrame) -> DataFrame:
        counts = [F.count(F.when(cond, F.lit(1))).alias(name) for name, cond in self._counted.items()]
        return rows.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self) -> dict[str, int]:
        return self._seen.get


def orphan(days: Iterable[_dt.date], hours: Iterable[int]) -> Column:
    """Fact rows without a date row or an hour row, given the run's date rows (at most one a day) and the hours."""
    known = F.col("dt").isin(list(days)) & F.col("d_time_id").isin(list(hours))
    return ~F.coalesce(known, F.lit(False))


def check(what: str, found: float, limit: float | None) -> None:
    if limit is not None and found > limit:
        raise GateClosed(f"{what}: {found} exceeds {limit}")
