"""Mixing sources to target weights.

Words are summed per source, each source gets a target and from it a repetition
rate, and every document is taken ``floor(rate)`` times plus one more time when a
hash of its id, read as a number in [0, 1), is below the fraction of the rate.

Defined results: a null text has size 0; rows with a null source form one source
that sorts last; a source of size 0 has target 0 and is never taken; rows that
repeat a doc_id draw the same hash, and a null doc_id draws that of the word
``null``; an empty table gives an empty table.
Extra columns are ignored by ``plan`` and passed through by ``emit``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import held, positions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SEED = "mix-1"
#: A table of rates is broadcast only up to this many sources and bytes of names.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 4 << 20


@dataclass(frozen=True)
class Recipe:
    """Weights by rank of the source, wanted share of all words, and cap on repeats.

    ``share`` and ``cap`` are whole numbers of halves (3 = 150 %, 4 = twice), so
    that targets are compared exactly.
    """

    weights: tuple[int, ...] = WEIGHTS
    share_halves: int = 3
    cap_halves: int = 4


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    The excess over a source's cap is dealt again by weight until no source is
    above its cap.  Each round is one sum over the table of sources; only those
    sums reach the driver.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(recipe.weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in recipe.weights]), (F.col("position") % n + 1).cast("int"))
    # ranks by code point, null last
    ranked = held(
        positions(sources, F.col("source").asc_nulls_last())
        .select("source", "source_size", weight.cast("long").alias("weight"))
    )
    whole = T.DecimalType(38, 0)
    size, w = F.col("source_size").cast(whole), F.col("weight").cast(whole)
    total = int(ranked.agg(F.sum(size)).first()[0] or 0)
    all_weights = int(ranked.agg(F.sum(w)).first()[0] or 0)
    # level = left / (2 * weights) words for each unit of weight; doubled to stay whole
    left, weights, capped = recipe.share_halves * total, all_weights, None
    while True:
        # both products fit decimal(38): sizes and sums of weights stay below 10^19
        over = (
            F.col("weight").cast("decimal(19,0)") * F.lit(left).cast("decimal(19,0)")
            > F.col("source_size").cast("decimal(19,0)") * F.lit(recipe.cap_halves * weights).cast("decimal(19,0)")
        )
        row = ranked.where(over).agg(F.count(F.lit(1)), F.sum(size), F.sum(w)).first()
        if row[0] == capped:
            break
        capped = row[0]
        left = recipe.share_halves * total - recipe.cap_halves * int(row[1] or 0)
        weights = all_weights - int(row[2] or 0)
    free = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(2 * weights or 1))
    return ranked.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.when(over, F.col("source_size").cast("double") * (recipe.cap_halves / 2)).otherwise(free).alias("target"),
    )


def _small(rates: DataFrame) -> DataFrame:
    """Broadcast the rates only when their size is known to be small."""
    n, size = rates.agg(F.count(F.lit(1)), F.sum(F.octet_length("source"))).first()
    return F.broadcast(rates) if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else rates


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from a hash of the id."""
    text = F.concat(F.lit(SEED + "|"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(doc_id: Column, target: Column, source_size: Column) -> Column:
    """floor(rate) plus the Bernoulli copy."""
    rate = F.when(source_size > 0, target / source_size.cast("double")).otherwise(F.lit(0.0))
    return (F.floor(rate) + (draw(doc_id) < rate - F.floor(rate)).cast("long")).cast("long")


def _rates(docs: DataFrame, recipe: Recipe) -> tuple[DataFrame, DataFrame]:
    sizes = held(docs.select("doc_id", "source", words(F.col("text")).alias("size")))
    return sizes, _small(held(targets(sizes, recipe)))


def plan(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) for each row of ``docs``."""
    sizes, rates = _rates(docs, recipe)
    rates = rates.withColumnRenamed("source", "_source")
    return sizes.join(rates, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("size") * copies(F.col("doc_id"), F.col("target"), F.col("source_size"))).alias("taken"),
    )


def emit(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as the mix takes it."""
    _, rates = _rates(docs, recipe)
    rates = rates.select(F.struct(F.col("source"), F.col("source_size"), F.col("target")).alias("__mix"))
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("__mix.source")), "left")
    n = copies(docs["doc_id"], F.col("__mix.target"), F.col("__mix.source_size"))
    return joined.withColumn("__mix", F.explode(F.array_repeat(F.lit(True), n.cast("int")))).drop("__mix")
