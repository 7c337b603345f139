"""How the landed months meet their contract, from the files themselves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.flags import MONTH
from tripmart.lake import Lake
from tripmart.operators import contract as C
from tripmart.operators import silver


def contract_by_month(spark: SparkSession, lake: Lake, service: str, months: Sequence[str]) -> DataFrame:
    """P2-P4, S7 for each landed month: columns found, absent and extra, rows, values
    that their cast loses, and whether the type probe and the contract pass.

    One match for each file schema; rows and losses are counted on the files in one
    scan for each schema. Months that break the contract are counted, not cast.
    """
    parts = []
    for raw in silver.read_raw_months(spark, lake, service, months):
        found = C.match(service, raw.columns)
        losses = [] if found.complaint else found.losses(raw.schema)
        names = [f"loss_{i}" for i in range(len(losses))]
        counted = raw.groupBy(F.col(C.FILE_MONTH).alias(MONTH)).agg(
            F.count(F.lit(1)).alias("filas"), *[c.alias(n) for c, n in zip(losses, names)]
        )
        lost = reduce(lambda a, b: a + b, [F.col(n) for n in names], F.lit(0).cast("bigint"))
        parts.append(counted.select(
            MONTH,
            F.lit(len(found.columns) - len(found.absent)).alias("columnas"),
            F.lit(",".join(found.absent)).alias("ausentes"),
            F.lit(",".join(found.extras)).alias("sobrantes"),
            "filas",
            (F.lit(None).cast("bigint") if found.complaint else lost).alias("perdidas"),
            F.lit(not C.type_probe(raw)).alias("tipos_ok"),
            F.lit(found.complaint is None).alias("contrato_ok"),
        ))
    return reduce(DataFrame.unionByName, parts)
