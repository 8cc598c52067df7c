"""A small table that every run writes as a whole."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from .runs import RunFolders
from .tables import replace_folder


class SnapshotStore(RunFolders):
    """Readers see the last finished run, so one that dies leaves the table as it was."""

    def read(self, as_of: datetime.date | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self._run(self._require(as_of))}/data")

    def publish(self, df: DataFrame, run_date: datetime.date, replay: bool = False) -> None:
        self.check_order(run_date, replay)
        self._begin(run_date)
        replace_folder(df, f"{self._run(run_date)}/data")
        self._finish(run_date, {})
