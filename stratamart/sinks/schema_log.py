"""A table by run days that knows its columns.

The manifest of a run holds the columns of all runs up to it, with their types and the run that
brought each in, so the table is read without opening a footer, and a run whose rows do not fit
is refused before it writes anything.
"""

from __future__ import annotations

import datetime
import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .runs import DAY, RunFolders
from .tables import replace_folder


class EvolvingTable(RunFolders):
    """Runs may add columns and leave some out; what a run lacks is null in its rows."""

    def read(self, as_of: datetime.date | None = None) -> DataFrame:
        """The rows of all runs up to a day under the columns known by then, and ``run_date``."""
        last = self._require(as_of)
        manifest = self._manifest(last)
        schema = StructType([*self._schema(manifest["columns"]).fields, StructField("run_date", DateType())])
        folders = [self._run(run) for run in manifest["runs"]]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)

    def columns(self, as_of: datetime.date | None = None) -> DataFrame:
        """The log: ``Position, Name, Type, Since``, one row per column."""
        known = self._manifest(self._require(as_of))["columns"]
        rows = [
            (at, column["field"]["name"], StructField.fromJson(column["field"]).dataType.simpleString(), datetime.date.fromisoformat(column["since"]))
            for at, column in enumerate(known)
        ]
        return self.spark.createDataFrame(rows, "Position int, Name string, Type string, Since date")

    def write(self, df: DataFrame, run_date: datetime.date, replay: bool = False) -> None:
        """Make a run day hold these rows.

        A column of another type than the table has is refused, and so is one that differs from a
        known one in case only, or is called ``run_date``. Repeating a day starts from the columns of
        the day before it.
        """
        self.check_order(run_date, replay)
        previous = self.latest(run_date - DAY)
        before: dict[str, Any] = {"columns": [], "runs": []} if previous is None else self._manifest(previous)
        columns = self._joined(before["columns"], df.schema, run_date)
        self._begin(run_date)
        replace_folder(df, self._run(run_date))
        self._finish(run_date, {"columns": columns, "runs": [*before["runs"], str(run_date)]})

    def _joined(self, known: list[dict[str, Any]], schema: StructType, run_date: datetime.date) -> list[dict[str, Any]]:
        by_name = {column["field"]["name"].lower(): column["field"] for column in known}
        joined = list(known)
        for field in schema.fields:
            if field.name.lower() == "run_date":
                raise ValueError(f"{self.path} has run_date as the name of its folders")
            old = by_name.get(field.name.lower())
            if old is None:
                # Older rows lack it, so it can be null whatever the frame says.
                new = StructField(field.name, field.dataType, True, field.metadata)
                joined.append({"field": json.loads(new.json()), "since": str(run_date)})
                continue
            kept = StructField.fromJson(old)
            if kept.name != field.name or kept.dataType != field.dataType:
                raise ValueError(
                    f"{self.path} has {kept.name} {kept.dataType.simpleString()}, not {field.name} {field.dataType.simpleString()}"
                )
        return joined

    def _schema(self, columns: list[dict[str, Any]]) -> StructType:
        return StructType([StructField.fromJson(column["field"]) for column in columns])
