from __future__ import annotations

import datetime
import glob
import os

from helpers import GOOD, rows_of

from stratamart import storage
from stratamart.schemas import RAW_COLUMNS
from stratamart.streaming import has_bronze, ingest_available, read_bronze

D1, D2 = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)


def drop(folder, name, *orders):
    os.makedirs(f"{folder}/landing", exist_ok=True)
    lines = [",".join(RAW_COLUMNS)]
    lines += [",".join({**GOOD, "OrderID": order}[c] for c in RAW_COLUMNS) for order in orders]
    with open(f"{folder}/landing/{name}.csv", "w") as file:
        file.write("\n".join([*lines, "too,short", ""]))


def ingest(spark, folder, day, **options):
    ingest_available(
        spark,
        f"{folder}/landing",
        f"{folder}/bronze",
        f"{folder}/checkpoint",
        day,
        archive=f"{folder}/archive",
        **options,
    )


def orders(spark, folder, day=None):
    rows = read_bronze(spark, f"{folder}/bronze", day).select("OrderID")
    return [row[0] for row in rows_of(rows)]


def names(folder):
    found = glob.glob(f"{folder}/**/*.csv", recursive=True)
    return sorted(os.path.basename(path) for path in found)


def test_each_file_once_and_archived_by_a_later_run(spark, folder):
    drop(folder, "a", "1", "2")
    ingest(spark, folder, D1)
    assert orders(spark, folder) == ["1", "2"]

    drop(folder, "b", "3")
    ingest(spark, folder, D2)
    assert orders(spark, folder) == ["1", "2", "3"]
    assert orders(spark, folder, D2) == ["3"]

    drop(folder, "c", "4")
    ingest(spark, folder, D2)
    assert orders(spark, folder) == ["1", "2", "3", "4"]
    assert orders(spark, folder, D1) == ["1", "2"]
    assert "a.csv" in names(f"{folder}/archive")
    assert "c.csv" in names(f"{folder}/landing")

    ingest(spark, folder, D2)
    assert orders(spark, folder) == ["1", "2", "3", "4"]
    assert "c.csv" in names(f"{folder}/landing")


def test_batches_are_bounded(spark, folder):
    for number in range(5):
        drop(folder, f"f{number}", str(number))
    ingest(spark, folder, D1, files_per_batch=2)
    assert len(glob.glob(f"{folder}/bronze/run_date=*/batch_id=*")) == 3
    assert orders(spark, folder) == ["0", "1", "2", "3", "4"]


def test_a_repeated_batch_counts_once(spark, folder):
    drop(folder, "a", "1")
    ingest(spark, folder, D1)
    drop(folder, "b", "2")
    ingest(spark, folder, D1)
    # As if the run had died between writing the batch and noting it as done.
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    ingest(spark, folder, D2)
    assert orders(spark, folder) == ["1", "2"]
    assert orders(spark, folder, D2) == ["2"]


def test_days_without_files(spark, folder):
    assert not has_bronze(spark, f"{folder}/bronze", D1)
    drop(folder, "a", "1")
    ingest(spark, folder, D1)
    assert has_bronze(spark, f"{folder}/bronze", D1)
    assert not has_bronze(spark, f"{folder}/bronze", D2)


def test_a_day_is_read_without_listing_the_others(spark, folder, monkeypatch):
    for number in range(50):
        os.makedirs(f"{folder}/bronze/run_date=2023-01-{number % 28 + 1:02d}/batch_id={1000 + number}")
    drop(folder, "a", "1")
    ingest(spark, folder, D1)
    asked = []
    plain = storage.matching
    monkeypatch.setattr(storage, "matching", lambda session, path: asked.append(path) or plain(session, path))
    assert has_bronze(spark, f"{folder}/bronze", D1)
    assert all(f"run_date={D1}/" in path for path in asked)
    files = read_bronze(spark, f"{folder}/bronze", D1).inputFiles()
    assert files and all(f"run_date={D1}/batch_id=0/" in path for path in files)


def test_all_columns_arrive(spark, folder):
    drop(folder, "a", "1")
    ingest(spark, folder, D1)
    assert rows_of(read_bronze(spark, f"{folder}/bronze")) == [tuple(GOOD.values())]
