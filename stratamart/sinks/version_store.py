"""A versioned dimension on plain files.

Keys are hashed into a fixed number of buckets. A run writes the buckets in which a version was
added or closed, in one job, and leaves all others where they are::

    <path>/run_date=2024-05-01/state=open/bucket=7/      versions in force after the run
    <path>/run_date=2024-05-01/state=closed/bucket=7/    the versions that this run closed

Its manifest names for each bucket the run that wrote its open versions last, and the runs that
closed versions, so the table as of a day is found without looking into other folders. History
is only ever added to. Repeating a run starts again from the run before it.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .. import storage
from ..functions import none_null
from ..operators.versions import (
    EXPIRED,
    HISTORY,
    NEW_KEY,
    UNCHANGED,
    metric_columns,
    scd2_bootstrap,
    scd2_step,
)
from ..schemas import VERSION_COLUMNS
from .runs import DAY, RunFolders
from .tables import replace_folder, write_parquet

MOST_BUCKETS = 1 << 15


class VersionStore(RunFolders):
    """``buckets`` are fixed by the first run: about bytes of the open versions / 256 MB."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        super().__init__(spark, path)
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"{buckets} buckets; up to {MOST_BUCKETS} are possible")
        self.buckets = buckets

    def read(self, as_of: datetime.date | None = None) -> DataFrame:
        """All versions as they were known after the last run up to ``as_of``."""
        manifest = self._open_manifest(self._require(as_of))
        closed = [f"{self._run(run)}/state=closed/bucket=*" for run in manifest["closed"]]
        return self._load([*closed, *self._folders(manifest["open"])], manifest)

    def current(self, as_of: datetime.date | None = None) -> DataFrame:
        """The versions in force after the last run up to ``as_of``; history is not opened."""
        manifest = self._open_manifest(self._require(as_of))
        return self._load(self._folders(manifest["open"]), manifest)

    def load(self, versions: DataFrame, run_date: datetime.date, keys: Sequence[str]) -> dict[str, int]:
        """Start a store from an existing versioned table."""
        if self.latest():
            raise ValueError(f"{self.path} already has runs; a load would replace history")
        if versions.where("is_current").isEmpty():
            raise ValueError("a table to load needs at least one version in force")
        change = F.when(F.col("is_current"), F.lit(NEW_KEY)).otherwise(F.lit(HISTORY))
        return self._start(versions.withColumn("change", change), keys, run_date)

    def apply(
        self,
        incoming: DataFrame,
        keys: Sequence[str],
        attributes: Sequence[str],
        run_date: datetime.date,
        null_safe: bool = True,
        replay: bool = False,
    ) -> dict[str, int]:
        """Record what came in on a day and return the counts of the run.

        Runs go forward in time. To repeat a day in the past, set ``replay`` and then
        repeat the days after it too, in order, since each builds on the one before.
        """
        self.check_order(run_date, replay)
        last = self.latest()
        previous = self.latest(run_date - DAY)
        identified = incoming.select(*keys, *attributes).where(none_null(keys))
        if previous is None:
            if last and self._is_start_of_other_rows(run_date):
                raise ValueError(f"{self.path} starts with its table of {self.runs()[0]}")
            first = scd2_bootstrap(identified, run_date)
            return self._start(first.withColumn("change", F.lit(NEW_KEY)), keys, run_date)
        before = self._open_manifest(previous)
        if list(keys) != before["keys"]:
            raise ValueError(f"{self.path} has its versions by {before['keys']}, not by {list(keys)}")
        self._begin(run_date)

        path, bucket = self._run(run_date), self._bucket(keys, before["buckets"])
        kinds = {field.name: field.dataType for field in self._columns(before)}
        typed = identified.withColumns({name: F.col(name).cast(kinds[name]) for name in keys})
        met = Observation(f"incoming {run_date}")
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(bucket.cast("long") + 1))
        replace_folder(typed.observe(met, bits.alias("buckets")), f"{path}/_incoming")
        staged = self.spark.read.schema(typed.schema).parquet(f"{path}/_incoming")

        # Only buckets that a key comes in for are read, and only those with a change are written.
        bitmap = bytes(met.get["buckets"])
        read = {at for at in range(before["buckets"]) if bitmap[at >> 3] >> (at & 7) & 1}
        current = self._load(self._folders(before["open"], read), before)
        for name in attributes:
            if name not in current.columns:
                kind = identified.schema[name].dataType
                current = current.withColumn(name, F.lit(None).cast(kind))
        counts = Observation(f"versions {run_date}")
        stepped = scd2_step(current, staged, keys, attributes, run_date, null_safe)
        changes = stepped.observe(counts, *metric_columns()).where(F.col("change") != UNCHANGED)
        replace_folder(changes.withColumn("bucket", bucket), f"{path}/_changes")
        found = dict(counts.get)
        unread = before["active"] - found["Changed"] - found["Unchanged"]
        for name in ("Unchanged", "Total", "Active"):
            found[name] += unread

        columns = [name for name in stepped.columns if name != "change"]
        kept = stepped.select(columns).schema
        tagged = StructType([*kept.fields, StructField("change", StringType()), StructField("bucket", IntegerType())])
        changed = self.spark.read.schema(tagged).parquet(f"{path}/_changes")
        touched = {row["bucket"] for row in changed.select("bucket").distinct().collect()}
        manifest = {**before, "columns": kept.json(), "active": found["Active"]}
        if touched:
            stayed = self._load(self._folders(before["open"], touched), {**before, "columns": kept.json()})
            closed = changed.where(F.col("change") == EXPIRED)
            stayed = stayed.join(closed.select(*keys), list(keys), "left_anti")
            rows = stayed.select(columns).unionByName(changed.select(columns))
            self._write(rows, keys, before["buckets"], run_date)
            manifest["open"] = before["open"] | dict.fromkeys(map(str, touched), str(run_date))
            manifest["closed"] = before["closed"] + [str(run_date)] * bool(found["Changed"])
        self._finish(run_date, manifest)
        for name in ("_incoming", "_changes"):
            storage.remove(self.spark, f"{path}/{name}")
        return found

    def forget_snapshots(self, before: datetime.date) -> list[datetime.date]:
        """Remove open versions as they were after runs before a day, where no later run has them
        in use; returns the days.

        The table after the last run stays, and so does all history. What is lost is reading the
        table as of these days, and repeating the days right after them.
        """
        runs = self.runs()
        manifests = {run: self._manifest(run) for run in runs}
        forgotten = [run for run in runs[:-1] if run < before and not manifests[run].get("forgotten")]
        in_use = {
            (run, bucket)
            for day, manifest in manifests.items()
            if day not in forgotten and not manifest.get("forgotten")
            for bucket, run in manifest["open"].items()
        }
        for run in forgotten:
            self._finish(run, {**manifests[run], "forgotten": True})
        for run in runs:
            if run < before:
                folder = f"{self._run(run)}/state=open"
                for name in storage.child_names(self.spark, folder):
                    if name.startswith("bucket=") and (str(run), name.removeprefix("bucket=")) not in in_use:
                        storage.remove(self.spark, f"{folder}/{name}")
        return forgotten

    def _is_start_of_other_rows(self, run_date: datetime.date) -> bool:
        """Whether the first run is not simply a bootstrap on this day, to be done again."""
        first = self.runs()[0]
        if first != run_date or self._manifest(first)["closed"]:
            return True
        older = F.col("valid_from") < F.lit(first)
        return not self.current(as_of=first).where(older).isEmpty()

    def _open_manifest(self, run: datetime.date) -> dict[str, Any]:
        manifest = self._manifest(run)
        if manifest.get("forgotten"):
            raise LookupError(f"{self.path} no longer holds the open versions of {run}")
        if "open" not in manifest:
            raise LookupError(f"{self.path} was written without buckets; load its table into a new store")
        return manifest

    def _bucket(self, keys: Sequence[str], count: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")

    def _folders(self, buckets: dict[str, str], chosen: set[int] | None = None) -> list[str]:
        wanted = sorted((run, bucket) for bucket, run in buckets.items() if chosen is None or int(bucket) in chosen)
        return [f"{self._run(run)}/state=open/bucket={bucket}" for run, bucket in wanted]

    def _columns(self, manifest: dict[str, Any]) -> StructType:
        return StructType.fromJson(json.loads(manifest["columns"]))

    def _load(self, folders: list[str], manifest: dict[str, Any]) -> DataFrame:
        # Runs may have gained attributes; the columns are those of the last one, and no footers
        # need to be merged.
        columns = self._columns(manifest)
        names = [name for name in columns.names if name not in VERSION_COLUMNS]
        if not folders:
            return self.spark.createDataFrame([], columns).select(*names, *VERSION_COLUMNS)
        return self.spark.read.schema(columns).parquet(*folders).select(*names, *VERSION_COLUMNS)

    def _start(self, tagged: DataFrame, keys: Sequence[str], run_date: datetime.date) -> dict[str, int]:
        """Write a run that builds on no other; without any version it is no run."""
        self._begin(run_date)
        counts = Observation(f"versions {run_date}")
        self._write(tagged, keys, self.buckets, run_date, counts)
        rows, found = tagged.drop("change"), counts.get
        if found["Total"]:
            names = storage.child_names(self.spark, f"{self._run(run_date)}/state=open")
            written = [name.removeprefix("bucket=") for name in names if name.startswith("bucket=")]
            manifest = {
                "keys": list(keys),
                "buckets": self.buckets,
                "columns": rows.schema.json(),
                "open": dict.fromkeys(written, str(run_date)),
                "closed": [str(run_date)] * bool(found["Historical"]),
                "active": found["Active"],
            }
            self._finish(run_date, manifest)
        return found

    def _write(
        self, rows: DataFrame, keys: Sequence[str], buckets: int, run_date: datetime.date, counts: Observation | None = None
    ) -> None:
        """Open and closed versions by bucket, a file each; tagged ones can be counted meanwhile."""
        state = F.when(F.col("is_current"), F.lit("open")).otherwise(F.lit("closed"))
        placed = rows.withColumns({"state": state, "bucket": self._bucket(keys, buckets)})
        path = self._run(run_date)
        for name in ("open", "closed"):
            storage.remove(self.spark, f"{path}/state={name}")
        dealt = placed.repartition("bucket")
        if counts is not None:
            dealt = dealt.observe(counts, *metric_columns())
        writer = dealt.drop("change").write.mode("append")
        write_parquet(dealt, writer.partitionBy("state", "bucket"), path)
