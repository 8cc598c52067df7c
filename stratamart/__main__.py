"""The daily run from the command line: python -m stratamart LANDING ROOT --run-date DAY"""

from __future__ import annotations

import argparse
import datetime
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans.daily import Warehouse, run_daily


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stratamart", description=__doc__)
    parser.add_argument("landing", help="folder in which feed files arrive")
    parser.add_argument("root", help="folder of the warehouse")
    parser.add_argument("--run-date", required=True, type=datetime.date.fromisoformat)
    parser.add_argument("--archive", help="folder for feed files that were taken over")
    parser.add_argument("--id-type", choices=["int", "bigint"], default="bigint")
    parser.add_argument(
        "--whole-extracts", action="store_true", help="the files of a day are the whole feed"
    )
    parser.add_argument(
        "--replay", action="store_true", help="repeat a day before the last one; then the later ones"
    )
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("stratamart").getOrCreate()
    warehouse = Warehouse(
        chosen.landing, chosen.root, chosen.archive, chosen.id_type, chosen.whole_extracts
    )
    print(json.dumps(run_daily(spark, warehouse, chosen.run_date, chosen.replay)))


if __name__ == "__main__":
    main()
