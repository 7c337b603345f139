"""Document fingerprints from closed syncmers.

A text is a sequence of tokens: single ideographs or kana, and runs of other
characters between white space, in lower case.  A run of ``K`` tokens is an anchor
when the smallest hash among its inner runs of ``S`` tokens stands at its first or
last place (a closed syncmer).  Whether a run is chosen depends on that run alone, so
equal passages give equal anchors whatever stands around them.

The fingerprint is made of all anchors and their places: 32 hex digits over the whole
sequence, which differ as soon as one anchor or place does, and after them the
``SKETCH`` smallest hashes, for comparisons outside of this module.  Likeness compares
all anchors of two texts by place: each distinct hash counts once, with its first
place; the shift that most common hashes share is the texts' common shift, and those
within ``DRIFT`` tokens of it match.  Likeness is the share of matching hashes among all
of both, so a passage that moved away counts as lost, and a few words put in do not.

Only DataFrame functions; the one shuffle of texts brings each document beside the
next one.

Defined results: a null text is the empty text, its fingerprint has no hashes and is alike
(1.0) only to another empty one; a text without any chosen run has one anchor, its
whole sequence; places count modulo 2^24 tokens; of several shifts that equally many
hashes share the smallest is the common one; rows without an id come last, and rows
without an id or that repeat one are ordered by a hash of their text; a table of one
row has itself as next; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 5, 2
SKETCH = 64
#: Matching anchors may stand this many tokens off the common shift.
DRIFT = 32
#: Bits of an anchor hash kept, hex digits that hold them, and bits of a place.
BITS, DIGITS, PLACE_BITS = 38, 10, 24
#: Bytes of text, and rows, that a range of neighbouring ids holds at about.
RANGE_BYTES, RANGE_ROWS = 128 << 20, 200_000
TOKEN = (
    r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
    r"|[^\x20\x09-\x0D\p{IsHan}\p{IsHiragana}\p{IsKatakana}]+"
)


def _kept(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BITS)


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with an array column ``name`` of anchors (pos, hash) of column ``text``.

    Every array that a lambda reads is a column of its own before, so that no array
    is built again for each element.
    """
    h, a, at = f"{name}__h", f"{name}__a", f"{name}__at"
    tokens = F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))
    df = df.withColumn(h, F.transform(tokens, lambda t: F.xxhash64(t)))
    n = F.size(h)

    def span(first: Column | int, last: Column) -> Column:
        return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))

    inner = F.transform(span(0, n - S), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))
    df = df.withColumn(a, inner)
    wide = K - S  # the inner runs of a run stand at places 0 .. wide

    def chosen(i):
        return F.least(F.get(a, i), F.get(a, i + wide)) <= F.least(*[F.get(a, i + j) for j in range(1, wide)])

    df = df.withColumn(at, F.filter(span(0, n - K), chosen))
    runs = F.transform(
        F.col(at), lambda i: F.struct(i.alias("pos"), _kept(F.xxhash64(*[F.get(h, i + j) for j in range(K)])).alias("hash"))
    )
    whole = F.array(F.struct(F.lit(0).alias("pos"), _kept(F.xxhash64(F.col(h))).alias("hash")))
    none = F.slice(whole, 1, 0)
    return df.withColumn(
        name, F.when(F.size(at) > 0, runs).when(n > 0, whole).otherwise(none)
    ).drop(h, a, at)


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS + 1)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def with_places(df: DataFrame, anchors: str, name: str) -> DataFrame:
    """``df`` with ``name``_all, the anchors packed into longs (hash, a free bit, place) in ascending
    order, and ``name``, the first of them for each hash."""
    packed = F.transform(anchors, lambda x: F.shiftleft(x["hash"], PLACE_BITS + 1).bitwiseOR(_place_of(x["pos"].cast("long"))))
    every = f"{name}_all"
    df = df.withColumn(every, F.sort_array(packed))
    return df.withColumn(name, F.filter(every, lambda x, i: (i == 0) | (_hash_of(F.get(every, i - 1)) != _hash_of(x))))


def fingerprint(name: str) -> Column:
    """All anchors with their places as 32 hex digits, then the smallest hashes."""

    def digits(x, n):
        return F.lpad(F.lower(F.hex(x)), n, "0")

    every = F.col(f"{name}_all")
    smallest = F.transform(F.slice(name, 1, SKETCH), lambda x: digits(_hash_of(x), DIGITS))
    whole = F.concat(digits(F.xxhash64(every), 16), digits(F.xxhash64(F.lit(1).cast("long"), every), 16))
    return F.concat(whole, F.array_join(smallest, ""))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with the likeness of two texts' anchors (columns of ``with_places``), 0 to 1.

    Both sides are sorted together, so a common hash is two neighbours; the shifts, sorted,
    stand in runs, and the longest run is the common shift.
    """
    c, t, starts, mode = (f"{name}__{x}" for x in ("c", "t", "starts", "mode"))
    other = F.transform(b, lambda x: x.bitwiseOR(F.lit(1 << PLACE_BITS)))
    df = df.withColumn(c, F.sort_array(F.concat(a, other)))
    met = F.filter(
        F.transform(c, lambda x, i: F.when(
            (i > 0) & (_hash_of(F.get(c, i - 1)) == _hash_of(x)), _place_of(x) - _place_of(F.get(c, i - 1)))),
        lambda x: x.isNotNull(),
    )
    df = df.withColumn(t, F.sort_array(met))
    edges = F.filter(F.transform(t, lambda x, i: F.when((i == 0) | (F.get(t, i - 1) != x), i)), lambda i: i.isNotNull())
    df = df.withColumn(starts, edges)
    runs = F.transform(starts, lambda s, k: F.struct(
        (F.coalesce(F.get(starts, k + 1), F.size(t)) - s).alias("n"), (-F.get(t, s)).alias("shift")))
    df = df.withColumn(mode, -F.array_max(runs)["shift"])
    matched = F.size(F.filter(t, lambda x: F.abs(x - F.col(mode)) <= DRIFT))
    either = F.size(a) + F.size(b) - matched
    return df.withColumn(name, F.when(either == 0, F.lit(1.0)).otherwise(matched / either)).drop(c, t, starts, mode)


def _bucket(doc_id: Column, bounds: list[int], null_bits: int) -> Column:
    """Number of bounds at or below the id, by bisection; rows without an id come last,
    in 2^``null_bits`` ranges of their text's hash."""
    nameless = len(bounds) + 1 + F.shiftright(F.xxhash64("text"), 64 - null_bits) + (1 << null_bits - 1)
    if not bounds:
        return F.when(doc_id.isNull(), nameless).otherwise(0)
    table = F.lit(bounds)
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = F.get(table, mid) <= doc_id
        return F.when(s["lo"] < s["hi"], F.struct(
            F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(right, s["hi"]).otherwise(mid).alias("hi")
        )).otherwise(s)

    found = F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length())), start, halve)["lo"]
    return F.when(doc_id.isNull(), nameless).otherwise(found)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with a struct column ``next`` of ``columns`` of the next row by doc_id.

    Rows are dealt into ranges of ids, as many as their rows and bytes ask for and at least
    one for each shuffle partition; inside a range the next row is a window away, and a
    range's last row gets the first row of the next range, or of the first one after the last.
    """
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    n = max(1, least, -(-rows // RANGE_ROWS), -(-size // RANGE_BYTES))
    null_bits = max(1, n.bit_length())
    fractions = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", fractions, 20 * n)).first()[0] if fractions else None
    bounds = sorted(set(found or []))
    spread = docs.withColumn("bucket", _bucket(F.col("doc_id"), bounds, null_bits).cast("int"))
    # the first id of each range that has rows: one small row for each range
    starts = spread.groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    order = Window.orderBy("bucket")
    ring = starts.select(
        F.col("bucket").alias("head"), "first_id",
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("bucket"),
    )
    by_text = F.xxhash64("text")
    heads = (
        spread.join(F.broadcast(ring.select("head", "first_id")),  # one row for each range
                    (F.col("bucket") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("head").agg(F.min_by(F.struct(*columns), by_text).alias("after"))
        .join(ring.select("head", "bucket"), "head").select("bucket", "after")
    )
    inside = Window.partitionBy("bucket").orderBy(F.asc_nulls_last("doc_id"), by_text)
    led = spread.withColumn("next", F.lead(F.struct(*columns)).over(inside))
    joined = led.join(heads.withColumnRenamed("bucket", "_bucket"),
                      (F.col("bucket") == F.col("_bucket")) & F.col("next").isNull(), "left")
    return joined.withColumn("next", F.coalesce("next", "after")).drop("bucket", "_bucket", "after")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text has its last half (rounded down) replaced by as many first code
    points of the next document, or all of them if there are fewer.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = with_next(rows, ["text"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    texts = near.select(
        "doc_id", n.cast("long").alias("n_chars"), "text", F.col("next.text").alias("after"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"),
    )
    for text, name in (("text", "own"), ("after", "next"), ("edited", "changed")):
        texts = with_places(with_anchors(texts, text, f"{name}_anchors"), f"{name}_anchors", name).drop(f"{name}_anchors")
    texts = with_likeness(with_likeness(texts, "own", "changed", "near_edited"), "own", "next", "near_next")
    return texts.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("changed").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
