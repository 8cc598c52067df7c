"""Which bronze batches have reached every gold table."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from .runs import RunFolders


class BatchLedger(RunFolders):
    """One entry a day, written last of all; a day without one is still to be run.

    A run that died leaves bronze batches behind that the stream will not bring again. Their
    day has no entry, whatever tables the run had finished, so the next run finds and repeats it.
    """

    def unfinished(self, bronze_days: Iterable[datetime.date], before: datetime.date) -> list[datetime.date]:
        """The days before a day that have bronze and no entry, oldest first."""
        done = set(self.runs())
        return sorted(day for day in bronze_days if day < before and day not in done)

    def batches(self, day: datetime.date) -> list[int]:
        return self._manifest(day)["batches"]

    def reopen(self, day: datetime.date) -> None:
        """Take the entry of a day back, and those of later days, which build on it."""
        self._begin(day)

    def record(self, day: datetime.date, batches: Iterable[int]) -> None:
        self._begin(day)
        self._finish(day, {"batches": sorted(batches)})
