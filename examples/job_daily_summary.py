"""Refined events to the curated daily summary: python job_daily_summary.py --help

A job reads a table by its full name, transforms it, and appends to another one.
"""

from __future__ import annotations

import argparse

from stratalake import Lake, get_spark, read_lake, write_lake
from stratalake.operators import QualityChecker, daily_summary


def main() -> None:
    options = argparse.ArgumentParser()
    options.add_argument("--abbr", required=True)
    options.add_argument("--country", required=True)
    options.add_argument("--project", required=True)
    options.add_argument("--raw", required=True, help="bucket or folder of the raw layer")
    options.add_argument("--refined", required=True)
    options.add_argument("--curated", required=True)
    given = options.parse_args()

    spark = get_spark(f"{given.project}-daily-summary")
    lake = Lake(
        abbr=given.abbr,
        country=given.country,
        project=given.project,
        buckets={"raw": given.raw, "refined": given.refined, "curated": given.curated},
    )
    lake.create_databases(spark)

    events = read_lake(spark, lake.table("refined", "events"))
    summary = daily_summary(events, "created_at", "value")
    write_lake(
        df=summary,
        table=lake.table("curated", "daily_summary"),
        mode="overwrite",
        audit=lambda written: QualityChecker(written).not_null("date").unique("date"),
    )
    spark.stop()


if __name__ == "__main__":
    main()
