"""Folders of runs, each valid by its manifest.

A table consists of folders ``<path>/run_date=2024-05-01``. The last thing a run writes is
``_manifest``, which says what the table consists of after it. A run that died has none, is
ignored and simply repeated. Reading takes one listing of the names of the runs and the
manifest of one of them; what the other folders hold is not looked at.
"""

from __future__ import annotations

import datetime
import json
from typing import Any

from pyspark.sql import SparkSession

from .. import storage

DAY = datetime.timedelta(days=1)


class RunFolders:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def runs(self) -> list[datetime.date]:
        """Days of the finished runs, oldest first."""
        return [day for day in self._days() if self._is_finished(day)]

    def latest(self, as_of: datetime.date | None = None) -> datetime.date | None:
        """The last finished run up to a day. Looks into as few folders as possible."""
        days = (day for day in reversed(self._days()) if as_of is None or day <= as_of)
        return next((day for day in days if self._is_finished(day)), None)

    def check_order(self, run_date: datetime.date, replay: bool = False) -> None:
        """Refuse a day before the last run, unless it is to be replayed."""
        last = self.latest()
        if last and run_date < last and not replay:
            raise ValueError(f"{self.path} has a run of {last}, later than {run_date}")

    def _days(self) -> list[datetime.date]:
        names = storage.child_names(self.spark, self.path)
        fields = (name.partition("=") for name in names)
        return [datetime.date.fromisoformat(day) for key, _, day in fields if key == "run_date"]

    def _run(self, day: datetime.date | str) -> str:
        return f"{self.path}/run_date={day}"

    def _is_finished(self, day: datetime.date) -> bool:
        return storage.exists(self.spark, f"{self._run(day)}/_manifest")

    def _require(self, as_of: datetime.date | None) -> datetime.date:
        last = self.latest(as_of)
        if last is None:
            raise LookupError(f"{self.path} has no finished run up to {as_of or 'now'}")
        return last

    def _manifest(self, day: datetime.date) -> dict[str, Any]:
        return json.loads(storage.read_text(self.spark, f"{self._run(day)}/_manifest"))

    def _begin(self, run_date: datetime.date) -> None:
        """Take back this run and the later ones, whose manifests build on it."""
        for day in self._days():
            if day >= run_date:
                storage.remove(self.spark, f"{self._run(day)}/_manifest")

    def _finish(self, run_date: datetime.date, manifest: dict[str, Any]) -> None:
        storage.write_text(self.spark, f"{self._run(run_date)}/_manifest", json.dumps(manifest))
