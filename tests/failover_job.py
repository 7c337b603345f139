"""Run by tests/test_failover.py in its own process: a silver backfill whose write
tasks fail on their first attempt must still commit each month exactly once."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from tripmart.lake import Lake  # noqa: E402
from tripmart.operators import silver  # noqa: E402
from tripmart.session import configure, scratch  # noqa: E402
from tripmart.sources import fixtures  # noqa: E402


MARKERS = os.environ.get("FAILOVER_MARKERS", "/tmp")


@F.udf(BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        # leave a trace that the attempt really failed (local mode: same machine)
        open(os.path.join(MARKERS, f"failed-stage{ctx.stageId()}-part{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return True


def main(sf_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")  # up to 4 attempts per task
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    configure(spark)
    lake = Lake(scratch(spark, "failover"))
    silver.land_raw(fixtures.trips_raw(spark, sf_dir), lake)
    months = silver.landed_raw_months(spark, lake, "yellow")
    expected = fixtures.trips_raw(spark, sf_dir).count()

    original = silver.transform

    def flaky_transform(raw, service, month=None):
        df, res = original(raw, service, month)
        return df.where(fail_first_attempt(F.col("mes"))), res

    silver.transform = flaky_transform
    report = silver.materialize(spark, lake, "yellow", months)
    silver.transform = original
    table = spark.read.parquet(lake.silver("yellow"))
    assert report.read == expected, (report.read, expected)
    assert report.written == expected and not report.unequal
    assert table.count() == expected
    assert table.select("mes").distinct().count() == len(months)
    failures = len([f for f in os.listdir(MARKERS) if f.startswith("failed-")])
    print("FAILURES", failures)
    print("FAILOVER_OK", report.read, report.flagged)


if __name__ == "__main__":
    main(sys.argv[1])
