"""Syncmers, licences and quotations: DataFrame functions only."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.brute import frame, odd_docs, sentence
from tripmart.llm import licenses, quotes, syncmers


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


# --- syncmers ----------------------------------------------------------------
def spark_hash(values, seed=42):
    for v in values:
        raw = v if isinstance(v, bytes) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


TOKEN = re.compile("[㐀-䶿一-鿿々ぁ-ゟァ-ヺヽ-ヿ]"
                   "|[^\\x20\\x09-\\x0D㐀-䶿一-鿿々ぁ-ゟァ-ヺヽ-ヿ]+")


def anchors(text):
    h = [spark_hash([t.encode()]) for t in TOKEN.findall(text.lower())]
    inner = [spark_hash(h[i : i + 2]) for i in range(len(h) - 1)]
    chosen = [i for i in range(len(h) - 4) if min(inner[i : i + 4]) in (inner[i], inner[i + 3])]
    keep = lambda x: (x & (1 << 64) - 1) >> 26
    if chosen:
        return [(i, keep(spark_hash(h[i : i + 5]))) for i in chosen]
    return [(0, keep(spark_hash(h)))] if h else []


def fingerprint(text):
    packed = sorted(x << 25 | i for i, x in anchors(text))
    smallest = sorted({x for _, x in anchors(text)})[:64]
    whole = [spark_hash(packed) if packed else 42, spark_hash([1, *packed])]
    return "".join(f"{x & (1 << 64) - 1:016x}" for x in whole) + "".join(f"{x:010x}" for x in smallest)


def likeness(a, b):
    """First places of all hashes; those near the shift that most of them share match."""
    a, b = ({x: i for i, x in reversed(anchors(t))} for t in (a, b))
    shifts = [b[x] - a[x] for x in a.keys() & b.keys()]
    common = min(shifts, key=lambda s: (-shifts.count(s), s), default=0)
    matched = sum(abs(s - common) <= 32 for s in shifts)
    return matched / (len(a) + len(b) - matched) if a or b else 1.0


def expected_prints(rows):
    rows = sorted(((r[0], r[1] or "") for r in rows),
                  key=lambda r: (r[0] is None, r[0] or 0, spark_hash([r[1].encode()])))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(text),
                    fingerprint(edited), likeness(text, edited), likeness(text, after)))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "3", "8"])
def test_fingerprints_equal_plain_ones(spark, partitions):
    rng = random.Random(2)
    rows = [(i * 7, sentence(rng, rng.choice([0, 1, 4, 5, 6, 30, 200])), "en", "s", 0) for i in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = syncmers.fingerprints(frame(spark, rows))
        no_python(df)
        assert sorted(map(tuple, df.collect()), key=str) == expected_prints(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_odd_rows(spark):
    rows = odd_docs()
    got = sorted(map(tuple, syncmers.fingerprints(frame(spark, rows)).collect()), key=str)
    assert got == expected_prints(rows)
    assert syncmers.fingerprints(frame(spark, [])).count() == 0
    alone = syncmers.fingerprints(frame(spark, rows[:1])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_anchors_do_not_depend_on_context(spark):
    rng = random.Random(8)
    passage = sentence(rng, 60)
    df = spark.createDataFrame([(sentence(rng, 40) + " " + passage + " " + sentence(rng, 30), passage)], "a string, b string")
    both = syncmers.with_anchors(syncmers.with_anchors(df, "a", "x"), "b", "y").first()
    inside = {r.hash for r in both.y}
    assert inside and inside <= {r.hash for r in both.x}
    shifts = {r.pos - s.pos for r in both.x for s in both.y if r.hash == s.hash}
    assert shifts == {40}


def compared(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    for c, n in (("a", "x"), ("b", "y")):
        df = syncmers.with_places(syncmers.with_anchors(df, c, f"{n}_anchors"), f"{n}_anchors", n)
    df = syncmers.with_likeness(df, "x", "y", "like")
    return df.select("like", syncmers.fingerprint("x").alias("x"), syncmers.fingerprint("y").alias("y")).first()


def test_likeness_falls_with_moved_passages(spark):
    words = [f"w{i}" for i in range(20_000)]
    text = " ".join(words)
    swapped = compared(spark, text, " ".join(words[10_000:] + words[:10_000]))
    assert swapped.x != swapped.y and 0.3 < swapped.like < 0.36
    moved = compared(spark, text, " ".join(words[:2_000] + words[4_000:] + words[2_000:4_000]))
    assert moved.x != moved.y and 0.6 < moved.like < 0.7
    one = compared(spark, text, " ".join(words[:9_000] + ["other"] + words[9_001:]))
    assert one.x != one.y and 0.99 < one.like < 1
    put_in = compared(spark, text, " ".join(["a", "few", "more"] + words))
    assert put_in.x != put_in.y and put_in.like > 0.99
    within = compared(spark, text, " ".join(words[:10_000] + ["a", "few", "more"] + words[10_000:]))
    assert within.like > 0.99
    repeated = compared(spark, "one line of the text again " * 3_000, "one line of the text again " * 3_000)
    assert repeated.x == repeated.y and repeated.like == 1.0


# --- licences ----------------------------------------------------------------
def dice_scan(text):
    """Best match and all matches, every unit against every template."""
    sentences = re.sub(r"([.!?;])[\x20\x09-\x0D]+", r"\1\n", text)
    best = {}
    for unit in [text, *text.split("\n"), *sentences.split("\n")]:
        own = set(licenses.bigrams_of(unit))
        for name, template in licenses.TEMPLATES:
            theirs = set(licenses.bigrams_of(template))
            score = 2 * len(own & theirs) / (len(own) + len(theirs))
            if score >= licenses.THRESHOLD:
                best[name] = max(best.get(name, 0), score)
    first = min(best, key=lambda n: (-best[n], n)) if best else None
    return first, best.get(first, 0.0), ",".join(sorted(best))


def licence_rows():
    rng = random.Random(6)
    rows = odd_docs()
    for i, (_, template) in enumerate(licenses.TEMPLATES * 4):
        words = template.split()
        for _ in range(i // len(licenses.TEMPLATES)):
            words[rng.randrange(len(words))] = rng.choice(["other", "", "The", words[0]])
        notice = " ".join(words)
        text = rng.choice([notice, f"{sentence(rng, 20)}\n{notice.upper()}\n{sentence(rng, 9)}",
                           f"{sentence(rng, 12)}. {notice} {sentence(rng, 15)}."])
        rows.append((1000 + i, text, "en", "s", 0))
    rows.append((5000, "licensed to drive under the general rules of version 3 license", "en", "s", 0))
    return rows


def test_licences_equal_the_unpruned_scan(spark):
    rows = licence_rows()
    df = licenses.scan(frame(spark, rows))
    no_python(df)
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted(((r[0], *dice_scan(r[1] or "")) for r in rows), key=str)
    assert sum(r[1] is not None for r in got) > 30
    assert licenses.scan(frame(spark, [])).count() == 0


def test_key_words_are_in_every_match():
    for _, template in licenses.TEMPLATES:
        pairs = licenses.bigrams_of(template)
        low, high = licenses.size_bounds(len(pairs))
        keys = licenses.key_words(template)
        without = [p for p in pairs if not set(p.split()) & set(keys)]
        # even a unit made only of the template's other bigrams stays below the threshold
        assert 2 * len(without) < licenses.THRESHOLD * (len(without) + len(pairs))
        assert low <= len(pairs) <= high


# --- quotations --------------------------------------------------------------
MESSAGES = [
    (1, 0, "u", "Hello world this is the first.\n\nSecond paragraph goes here ok."),
    (1, 1, "a", "> hello   WORLD this is the first.\nYes I agree to that fully"),
    (1, 2, "u", "Unrelated message in the thread"),
    (1, 3, "a", ">> Hello world this is the first.\n> Yes I agree to that fully\nMe too, nested reply"),
    (1, 4, "u", " > Second paragraph goes here ok.\nabout the second"),
    (1, 5, "u", "> never said by anyone at all\nhm"),
    (1, 6, "u", ">>> Me too, nested reply\nDeep only"),
    (1, 2, "u", "Unrelated message in the thread"),
    (2, 0, "u", None), (2, None, "x", "> q\nz"), (2, 1, "u", "> Hello world this is the first.\nother conversation"),
    (None, 1, "u", "> a b c\nd"), (3, 0, "u", "same words again and again"), (3, 1, "u", "same words again and again"),
    (3, 2, "u", "> same words again and again\nto the latest"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_replies_stand_below_what_they_answer(spark):
    df = spark.createDataFrame(MESSAGES, SCHEMA).withColumns({c: F.lit("x") for c in ("key", "level", "path", "place", "unit")})
    out = quotes.conversations(df)
    no_python(out)
    rows = out.orderBy("conv_id", "place").collect()
    one = [(r.turn, r.depth, r.reply_to, r.text) for r in rows if r.conv_id == 1]
    first = MESSAGES[0][3]
    assert one == [
        (0, 0, None, first), (1, 1, 0, "Yes I agree to that fully"), (3, 2, 1, "Me too, nested reply"),
        (6, 3, 3, "Deep only"), (4, 1, 0, "about the second"),
        (2, 0, None, "Unrelated message in the thread"), (2, 0, None, "Unrelated message in the thread"), (5, 0, None, "hm"),
    ]
    assert [(r.turn, r.place, r.reply_to, r.text) for r in rows if r.conv_id == 2] == [
        (0, 0, None, ""), (1, 1, None, "other conversation"), (None, 2, None, "z")]
    assert [(r.turn, r.reply_to) for r in rows if r.conv_id == 3] == [(0, None), (1, None), (2, 1)]
    assert [(r.place, r.text) for r in rows if r.conv_id is None] == [(0, "d")]
    assert quotes.conversations(df.limit(0)).count() == 0


def test_messages_without_quotes_keep_their_order_and_text(spark):
    from tests.conftest import SF_SMALL

    source = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = quotes.conversations(source).orderBy("conv_id", "place").select("conv_id", "turn", "role", "text").collect()
    assert got == source.orderBy("conv_id", "turn").collect()


def test_long_quote_chains(spark):
    rows = [(1, 0, "u", "message number zero is here")]
    for i in range(1, 30):
        rows.append((1, i, "u", f"> {rows[-1][3].splitlines()[-1]}\nmessage number {i} is here too"))
    out = quotes.conversations(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    assert [r.depth for r in out] == list(range(30))


def test_quote_levels(spark):
    lines = ["plain", "> one", ">> two", "> > two", " >>>three", "a > b", ">", ""]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(quotes.level(F.col("line"))).collect()] == [0, 1, 2, 2, 3, 0, 1, 0]


def test_the_sql_of_the_query_gives_the_same_threads(spark, tmp_path):
    import duckdb

    from tools.oracle_check import digest
    from tripmart.llm.queries import ORACLE_SQL

    df = spark.createDataFrame(MESSAGES, SCHEMA)
    df.write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    found = con.execute(ORACLE_SQL["op2_quote_links"])
    columns = [c[0] for c in found.description]
    out = quotes.conversations(df)
    assert digest(out.columns, [tuple(r) for r in out.collect()]) == digest(columns, found.fetchall())
