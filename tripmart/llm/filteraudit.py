"""Filter interaction audit: what each filter removes under every order of the filters.

A document's failures are a mask of five bits.  Under an order of the filters it goes at
the first letter of the order that its mask holds.  Orders are ranked as Lehmer codes
rank them (lexicographically), so the orders that begin with one prefix are an interval
of ranks.  A mask removes at step s exactly under the prefixes of length s whose last
letter is the only one that it holds: its count is added where such an interval starts
and taken off where it ends, and a running sum over the 120 ranks gives the removals
of all orders at once.  Per part there are at most 31 masks, so all that follows the one
aggregate of the documents is small; no document is looked at for an order.

Defined results: a null text is empty; words are maximal runs without ASCII white space;
a null lang is the empty string; rows without a doc_id are identical to no smaller one, are no
smaller one for others, and have no labels; rows that repeat a doc_id count each, and are not
smaller than each other; labels that repeat a doc_id count as 1 if any of them does; null
labels count as 0; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 3
#: All orders by rank: permutations of an ascending string come in lexicographic order.
ORDERS = ["".join(p) for p in permutations(LETTERS)]
COUNTS = ("n", "good", "toxic")


def own_failures(text: Column) -> Column:
    """Bits of A to D, which a text has by itself."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    tests = (
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) > MOST_UPPER * F.char_length(text),
        text.rlike(r"[#$%&*|]"),
    )
    bits = F.lit(0)
    for i, fails in enumerate(tests):
        bits = bits + F.when(fails, 1 << i).otherwise(0)
    return bits


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters that they fail."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.md5(text)).alias("same"), own_failures(text).alias("own")
    )
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    no = F.lit(False)
    marked = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}
    ).unionByName(rows.where("doc_id IS NULL").withColumns({"good": no, "toxic": no}))  # null ids would meet in one task

    # One text may have very many copies: they are combined before each shuffle, and what is
    # left of a text is one row for each part and labels.  Those with the text's smallest id pass E.
    kind = ("same", "part", "own", "good", "toxic")
    by_id = marked.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("doc_id").isNotNull()
    groups = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(known, 0).otherwise(F.col("n"))), F.lit(0)).alias("unnamed"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("same"))
    passing = F.col("unnamed") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = groups.withColumn("passing", passing).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("own").alias("mask"), F.col("passing").alias("n")),
            F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )).alias("e"),
    ).select("part", "good", "toxic", "e.mask", "e.n").where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )


def intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first, end): under the orders of ranks first..end-1 the mask goes at the step."""
    found = []
    for step in range(1, 6):
        width = factorial(5 - step)  # orders that begin alike stand together
        for first in range(0, 120, width):
            prefix = ORDERS[first][:step]
            for mask in range(1, 32):
                failing = [c for c in prefix if mask >> LETTERS.index(c) & 1]
                if failing == [prefix[-1]]:
                    found.append((mask, step, first, first + width))
    return found


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    spark = docs.sparkSession
    found = masks(docs, labels)

    def total(letter: int, only: bool) -> Column:
        hit = F.col("mask") == (1 << letter) if only else F.col("mask").bitwiseAND(1 << letter) != 0
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    parts = found.groupBy("part").agg(
        F.sum("n").alias("all"),
        F.array(*[total(i, False) for i in range(5)]).alias("fails"),
        F.array(*[total(i, True) for i in range(5)]).alias("alone"),
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step")
    ranks = F.explode(F.sequence(F.lit(0), F.lit(119))).alias("rank")
    blank = parts.select("part", steps).select("part", "step", ranks).withColumns({c: F.lit(0).cast("long") for c in COUNTS})

    # a fixed table (31 masks, 5 steps), whatever the documents
    cover = spark.createDataFrame(intervals(), "mask int, step int, first int, end int")
    ends = found.join(F.broadcast(cover), "mask").select(
        "part", "step",
        F.explode(F.array(
            F.struct(F.col("first").alias("rank"), *[F.col(c) for c in COUNTS]),
            F.struct(F.col("end").alias("rank"), *[(-F.col(c)).alias(c) for c in COUNTS]),
        )).alias("e"),
    ).select("part", "step", "e.*").where("rank < 120")
    deltas = blank.unionByName(ends).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])

    # 120 rows in each running sum
    running = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gone = deltas.withColumns({c: F.sum(c).over(running) for c in COUNTS})
    order = F.element_at(F.array(*[F.lit(o) for o in ORDERS]), F.col("rank") + 1)
    letter = F.instr(F.lit(LETTERS), F.substr(order, F.col("step"), F.lit(1)))
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    own = Window.partitionBy("part", "letter")
    return (
        gone.join(parts, "part").withColumn("letter", letter)
        .withColumn("before", F.sum("n").over(so_far)).withColumn("shapley", F.sum("n").over(own))
        .select(
            "part", order.alias("filter_order"), "step",
            (F.col("all") - F.col("before")).alias("kept"), F.col("n").alias("removed"),
            (F.element_at("fails", F.col("letter")) - F.col("n")).alias("redundant"),
            F.element_at("alone", F.col("letter")).alias("unique_fails"),
            F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
        )
    )
