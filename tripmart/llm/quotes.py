"""Quotation linking: conversations in reply order, without their quotes.

A line's quote level is the number of ``>`` marks that open it.  Lines of one level in
a row form a passage; passages are cut into units (whole, paragraphs, lines), which are
normalised (case, white space) and hashed.  A quoted unit belongs to the latest earlier
message of its conversation that holds the same unit outside quotes.  A message answers
the message its least nested linked passage was taken from, the longest unit deciding,
then the latest message; without a link it opens a thread.  In a conversation a thread
starts at its opener's turn, and every answer stands below what it answers.

Only DataFrame functions.  Quoted and original units meet in one window for each unit,
ordered by turn, so a unit that very many messages hold costs no pairs; places are taken
from a range sort over all conversations, so one huge conversation is not one task.

Defined results: null texts are empty; a message without quotes keeps its text as it is;
messages with a null conv_id or turn link with nothing, and null turns come last; rows
that repeat conv_id, turn, role and text share one place and one answer, and places
count distinct messages; empty tables give empty tables; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import held, positions

#: Units other than whole passages must have so many normalised characters to link.
MIN_UNIT = 12
MARKS = r"^[\x20\x09]*((?:>[\x20\x09]?)+)"


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _content(line: Column) -> Column:
    return F.regexp_replace(line, MARKS, "")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def body(text: Column) -> Column:
    """The text without its quoted lines; unchanged if there are none."""
    left = F.array_join(F.filter(_lines(text), lambda x: level(x) == 0), "\n")
    return F.when(_quotes(text), left).otherwise(F.coalesce(text, F.lit("")))


def _quotes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"(?m)^[\x20\x09]*>")


def _key() -> Column:
    return F.xxhash64("conv_id", "turn", "role", "text").alias("key")


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, key, level, passage): runs of lines of one level, quote marks taken off."""
    lines = messages.select("conv_id", "turn", "key", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    lines = lines.select("conv_id", "turn", "key", "at", level(F.col("line")).alias("level"),
                         _content(F.col("line")).alias("line"))
    own = Window.partitionBy("key").orderBy("at")
    starts = F.coalesce((F.lag("level").over(own) != F.col("level")).cast("int"), F.lit(1))
    runs = lines.withColumn("starts", starts).withColumn("run", F.sum("starts").over(own))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    return runs.groupBy("conv_id", "turn", "key", "level", "run").agg(text.alias("passage")).drop("run")


def _units(found: DataFrame) -> DataFrame:
    """``found`` with one row for each distinct unit of its passage: (unit, size)."""
    whole = F.array(normal(F.col("passage")))
    paragraphs = F.transform(F.split("passage", r"\n[\x20\x09]*\n"), normal)
    lines = F.transform(F.split("passage", "\n"), normal)
    parts = F.filter(F.concat(paragraphs, lines), lambda u: F.length(u) >= MIN_UNIT)
    units = F.array_distinct(F.concat(F.filter(whole, lambda u: F.length(u) > 0), parts))
    rows = found.withColumn("unit_text", F.explode(units))
    return rows.withColumn("unit", F.sha2("unit_text", 256)).withColumn("size", F.length("unit_text")).drop(
        "unit_text", "passage"
    )


def replies(messages: DataFrame) -> DataFrame:
    """(key, parent, parent_turn, n_linked) of messages that quote: what they answer, if anything."""
    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").dropDuplicates(["key"])
    quoting = known.where(_quotes(F.col("text"))).select("conv_id").distinct()
    units = _units(passages(known.join(quoting, "conv_id", "left_semi")))
    # before its own turn: quotes come ahead of the originals of the same turn
    before = Window.partitionBy("conv_id", "unit").orderBy("turn", "is_original", "key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    original = F.when(F.col("level") == 0, F.struct(F.col("turn"), F.col("key")))
    linked = (
        units.withColumn("is_original", F.col("level") == 0)
        .withColumn("from", F.last(original, ignorenulls=True).over(before))
        .where("level > 0")
    )
    best = F.max_by(F.col("from"), F.struct(-F.col("level"), F.col("size"), F.col("from.turn"), F.col("from.key")))
    return linked.where("from IS NOT NULL").groupBy("key").agg(
        best.alias("best"), F.countDistinct("unit").alias("n_linked")
    ).select("key", F.col("best.key").alias("parent"), F.col("best.turn").alias("parent_turn"), "n_linked")


def _paths(messages: DataFrame, answers: DataFrame) -> DataFrame:
    """(conv_id, key, path): turns and keys from a thread's opener down to the message."""
    step = F.struct(F.coalesce(F.col("turn"), F.lit((1 << 63) - 1)).alias("turn"), F.col("key"))
    all_ = messages.select("conv_id", "turn", "key").dropDuplicates(["key"]).join(
        answers.select("key", "parent"), "key", "left"
    )
    roots = all_.where("parent IS NULL").select("conv_id", "key", F.array(step).alias("path"))
    waiting = held(all_.where("parent IS NOT NULL").select("conv_id", "key", "parent", step.alias("step")))
    done, layer = roots, roots
    left = waiting.count()
    while left:
        # an answer's turn is later than its parent's, so every round places some
        layer = held(
            waiting.join(layer.select(F.col("key").alias("parent"), "path"), "parent")
            .select("conv_id", "key", F.concat("path", F.array("step")).alias("path"))
        )
        placed = layer.count()
        if not placed:
            break
        left -= placed
        done = done.unionByName(layer)
    return done


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, place, depth, reply_to, n_linked, text) of each message."""
    messages = messages.select("conv_id", "turn", "role", "text").withColumn("key", _key())
    answers = held(replies(messages))
    paths = _paths(messages.select("conv_id", "turn", "key"), answers)
    # by conversation, then thread: an opener's path is a prefix of all its answers'
    ranked = positions(paths, F.col("conv_id").asc_nulls_last(), "path")
    starts = ranked.groupBy("conv_id").agg(F.min("position").alias("start"))
    starts = starts.withColumnRenamed("conv_id", "start_of")
    placed = (
        ranked.join(starts, F.col("conv_id").eqNullSafe(F.col("start_of")))
        .select("key", (F.col("position") - F.col("start")).alias("place"), (F.size("path") - 1).alias("depth"))
        .join(answers, "key", "left")
    )
    return messages.join(placed, "key").select(
        "conv_id", "turn", "role", "place", "depth", F.col("parent_turn").alias("reply_to"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"), body(F.col("text")).alias("text"),
    )
