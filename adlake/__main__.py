"""Command line: land CSV exports, run the layers, audit a database.

    python -m adlake land  --csv DIR --bronze-db DB        # DIR/<report_type>/*.csv -> DB.<report_type>
                           [--rfc] [--rejects-db DB]       # doubled quotes; records that do not fit -> DB.<report_type>
    python -m adlake check --bronze-db DB                  # the bronze tables against their contract
    python -m adlake run   --bronze-db DB [--silver-db ..] [--gold-db ..] [--analytics-db ..] [--format parquet]
                           [--facts-by-month] [--partition-by TABLE=COLUMN]
    python -m adlake audit --db DB [--expect silver|gold|kpi]

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
settings apply); nothing is collected to the driver except per-table outcomes.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.gold import DIMS, FACTS
from adlake.operators.kpi import KPI_NAMES
from adlake.operators.spec import SILVER_TABLES
from adlake.plans.catalog import audit, save_layer
from adlake.plans.pipeline import run
from adlake.session import shared_dir
from adlake.sources.bronze import BRONZE_DDL, MULTILINE_REPORTS, check_bronze, land_csv_quarantine, read_bronze, read_csv

LAYER_TABLES = {"silver": SILVER_TABLES, "gold": (*DIMS, *FACTS), "kpi": KPI_NAMES}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="adlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("land")
    a.add_argument("--csv", required=True)
    a.add_argument("--bronze-db", required=True)
    a.add_argument("--format", default="parquet")
    a.add_argument("--rfc", action="store_true")
    a.add_argument("--rejects-db")
    c = sub.add_parser("check")
    c.add_argument("--bronze-db", required=True)
    r = sub.add_parser("run")
    r.add_argument("--bronze-db", required=True)
    r.add_argument("--silver-db", default="adlake_silver")
    r.add_argument("--gold-db", default="adlake_gold")
    r.add_argument("--analytics-db", default="adlake_analytics")
    r.add_argument("--format", default="parquet")
    r.add_argument("--partition-by", action="append", default=[], metavar="TABLE=COLUMN[,COLUMN]")
    u = sub.add_parser("audit")
    r.add_argument("--facts-by-month", action="store_true")
    u.add_argument("--db", required=True)
    u.add_argument("--expect", choices=sorted(LAYER_TABLES))
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"adlake-{args.cmd}").getOrCreate()
    if args.cmd == "land":
        land(spark, args.csv, args.bronze_db, args.format, args.rfc, args.rejects_db).show(truncate=False)
    elif args.cmd == "check":
        check_bronze(spark, args.bronze_db).show(100, truncate=False)
    elif args.cmd == "run":
        run(spark, read_bronze(spark, args.bronze_db), args.silver_db, args.gold_db, args.analytics_db, args.format,
            {t: c.split(",") for t, c in (p.split("=", 1) for p in args.partition_by)}, args.facts_by_month).show(100, truncate=False)
    else:
        audit(spark, args.db, LAYER_TABLES[args.expect] if args.expect else None).show(100, truncate=False)


def land(spark: SparkSession, csv: str, bronze_db: str, fmt: str = "parquet", rfc: bool = False, rejects_db: str | None = None) -> DataFrame:
    """Land every report type that has a folder; outcomes of the bronze tables, and of the rejects where they are asked for.

    With ``rejects_db`` each file is parsed once, into the shared folder; accepted rows and rejected records become
    tables from there, and a report type with rejects still lands what fits.
    """
    there = {name: os.path.join(csv, name) for name in BRONZE_DDL if os.path.isdir(os.path.join(csv, name))}
    if rejects_db is None:
        return save_layer(spark, bronze_db, {n: read_csv(spark, p, BRONZE_DDL[n], n in MULTILINE_REPORTS, rfc) for n, p in there.items()}, fmt)
    both = {n: land_csv_quarantine(spark, p, shared_dir(spark, "adlake-landing"), BRONZE_DDL[n], n in MULTILINE_REPORTS, rfc) for n, p in there.items()}
    kept = save_layer(spark, bronze_db, {n: good for n, (good, _) in both.items()}, fmt)
    return kept.unionByName(save_layer(spark, rejects_db, {n: bad for n, (_, bad) in both.items()}, fmt).withColumn(
        "table_name", F.concat(F.lit(f"{rejects_db}."), "table_name")))


if __name__ == "__main__":
    main()
