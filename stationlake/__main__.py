"""``spark-submit``-able job: refresh a lake from its raw folders.

    python -m stationlake --readings RAW/stations --weather RAW/weather --root LAKE
    python -m stationlake ... --changed-as-of 2026    # only file years whose content changed
    python -m stationlake ... --years 2026 2025       # only these file years
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from stationlake.plans import run
from stationlake.sources.landing import requested_years


def main(arguments: list[str] | None = None) -> dict | None:
    parser = argparse.ArgumentParser(prog="stationlake", description=__doc__)
    parser.add_argument("--readings", required=True, help="folder of year=Y/*.csv")
    parser.add_argument("--weather", required=True, help="folder of year=Y/*.json")
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--site", default="Main site")
    parser.add_argument("--city", default="Main city")
    parser.add_argument("--lenient", action="store_true", help="leave out impossible times")
    parser.add_argument("--landed-at", help="time of this delivery, kept with the landed files")
    parser.add_argument("--freeze", action="store_true", help="with --changed-as-of: landed older years stay as they are")
    scope = parser.add_mutually_exclusive_group()
    scope.add_argument("--years", nargs="+")
    scope.add_argument("--changed-as-of", type=int, metavar="YEAR")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("stationlake").getOrCreate()
    lake = run.Lake(given.readings, given.weather, given.root, given.site, given.city)
    years = None
    if given.years:
        years = requested_years(given.years, 1990, 9999)
    elif given.changed_as_of:
        frozen = given.changed_as_of if given.freeze else None
        years = sorted(
            {
                year
                for table in ("readings", "weather")
                for year in run.changed_years(spark, lake, given.changed_as_of, table, frozen)
            }
        )
        if not years:
            print("nothing changed")
            return None
    outcome = run.run(spark, lake, not given.lenient, years, given.landed_at)
    summary = {k: outcome[k] for k in ("bronze", "silver", "published")}
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
