"""Write docs/PLANS.md: the physical plans of the main operators over written tables.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tripmart.lake import Lake  # noqa: E402
from tripmart.operators import checks, gold, landing, profile, serving, silver, zones  # noqa: E402
from tripmart.session import local_session, scratch  # noqa: E402
from tripmart.sources import fixtures  # noqa: E402
from tripmart.streaming import hourly  # noqa: E402

NOTES = {
    "raw landing (rebalance by month)": (
        "Hash exchange by month marked REBALANCE: adaptive execution splits a month above the "
        "advisory size and merges small ones; no range-sampling pass."
    ),
    "silver write (scan -> typed projection -> flags)": (
        "One stage, no exchange: the file split that is read is the split that is written; "
        "casts and flags run inside one whole-stage-codegen span."
    ),
    "gold mart over written silver": (
        "Flags are stored columns, so the NOT conjuncts reach the scan as pushed filters; only the "
        "columns the mart uses are read; partial HashAggregate before the only exchange."
    ),
    "gold refresh of two months": "PartitionFilters on mes: only the two months' files are listed and read.",
    "zone names (checked broadcast)": "The catalogue is broadcast after its size was proven small.",
    "gold vs silver": "Both sides aggregated to one row per month before the join.",
    "serving top-k with total": "TakeOrderedAndProject (no full sort); the total is one scalar subquery.",
    "speed profile per month": (
        "Exact ranks: what is left to rank after the rounds of binning, at most 50,000 rows for each "
        "month and percentile; the state of the rounds comes from the checkpoint folder."
    ),
    "landing classification": "Equi join on the object key; the planner picks broadcast or sort-merge by size.",
    "pending months": "Range built with sequence from aggregated bounds; anti joins on month.",
    "hourly counts": "Partial aggregation by hour before the exchange.",
}


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    lake = Lake(scratch(spark, "plans"))
    silver.land_raw(fixtures.trips_raw(spark, sf_dir), lake)
    months = silver.landed_raw_months(spark, lake, "yellow")
    raw = silver.read_raw_months(spark, lake, "yellow", months)[0]
    silver.materialize(spark, lake, "yellow", months)
    gold.build(spark, lake)
    s = spark.read.parquet(lake.silver("yellow"))
    m = serving.read_mart(spark, lake.gold())
    plans = {
        "raw landing (rebalance by month)": fixtures.trips_raw(spark, sf_dir)
        .withColumnRenamed("mes_archivo", "mes")
        .hint("rebalance", "mes"),
        "silver write (scan -> typed projection -> flags)": silver.transform(raw, "yellow")[0],
        "gold mart over written silver": gold.mart(s),
        "gold refresh of two months": gold.mart(s.where(F.col("mes").isin(months[:2]))),
        "zone names (checked broadcast)": zones.with_zone_names(m, fixtures.zones(spark, sf_dir)),
        "gold vs silver": checks.gold_vs_silver(s, m),
        "serving top-k with total": serving.trips(m, serving.TripFilter.parse(hora="18", limite="10")),
        "speed profile per month": profile.speed_profile(s),
        "landing classification": landing.classify(
            fixtures.listing(spark, sf_dir), fixtures.ledger(spark, sf_dir), excused=landing.TRIPS_NOT_PUBLISHED
        ),
        "pending months": landing.pending_months(
            fixtures.published_months(spark, sf_dir), fixtures.landed_months(spark, sf_dir), 3
        ),
        "hourly counts": hourly.hourly_counts(fixtures.table(spark, sf_dir, "events")),
    }
    root = lake.root
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` with local[8]; scratch paths shortened.", ""]
    for name, df in plans.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue().replace(root, "<lake>")
        out += [f"## {name}", "", NOTES[name], "", "```", text.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv[1:])
