"""Reports from the command line.

    spark-submit ... tradelens/__main__.py --source hdfs:///shop --report dashboard --out hdfs:///out

``--source`` holds the five canonical tables, one folder each.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tradelens.plans import report
from tradelens.plans.rfm import REFERENCE_DATE
from tradelens.session import tune, widen_shuffles
from tradelens.sources.tables import Tables

REPORTS = {"sql": report.sql_sections, "eda": report.eda_sections, "dashboard": report.dashboard}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tradelens", description=__doc__.splitlines()[0])
    parser.add_argument("--source", required=True)
    parser.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    parser.add_argument("--report", choices=list(REPORTS), default="dashboard")
    parser.add_argument("--reference-date", type=date.fromisoformat, default=REFERENCE_DATE)
    parser.add_argument("--out", required=True)
    parser.add_argument("--out-format", choices=["parquet", "csv"], default="parquet")
    options = parser.parse_args(arguments)

    spark = tune(SparkSession.builder.appName("tradelens").getOrCreate())
    read = {"parquet": Tables.from_parquet, "csv": Tables.from_csv}[options.format]
    tables = read(spark, options.source)
    widen_shuffles(spark, tables.input_bytes())
    sections = REPORTS[options.report](tables, options.reference_date)
    report.write_report(sections, options.out, options.out_format)


if __name__ == "__main__":
    main()
