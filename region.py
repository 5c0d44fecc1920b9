"""Build the regional tables and print the checks and reports.

    spark-submit region.py <folder of the source files>/ <folder for the tables>/
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from comarca.plans import run


def main(location: str, target: str) -> None:
    spark = SparkSession.builder.appName("comarca").getOrCreate()
    before = run.build_region(spark, location, target)
    shown = {**before, **run.region_checks(spark, target), **run.region_reports(spark, target)}
    for title, df in shown.items():
        print(title)
        df.show(30, truncate=False)


if __name__ == "__main__":
    main(*sys.argv[1:])
