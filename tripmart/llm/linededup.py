"""Line dedup by a segment-partition edit join.

Two lines are linked when they are equal or, from ``MIN_CHARS`` characters on, when at
most ``EDITS`` insertions, deletions or substitutions of a character turn one into the
other; a line's class is its component of links, and every line after the first of its
class (by doc_id, then line number) goes.

1. A line of length l is cut into EDITS + 1 segments.  If two lines are linked, a
   segment of the one is a substring of the other near the same place, so each line
   is posted under (length, segment number, segment) and probes the lengths it can
   match with the substrings in the multi-match window.
2. Postings travel as packed arrays.  Lines that meet under a key are tied to the
   key's first line, within each batch first, so a frequent key is posted once a batch;
   that is a candidate group, not a list of pairs.
3. A candidate group's texts come together once, large groups as pairs of blocks.  Pairs
   not linked yet whose character counts differ little enough in every window (an edit
   changes a window's counts by two at most), or that are equal after deletions where
   little is left between common ends, are verified by banded bit-parallel edit distance.

Defined results: lines of white space only stay, and no line shorter than
``MIN_CHARS`` is linked to another text; rows with a null doc_id or a null text take no part and stay as they are;
rows that repeat a doc_id share their lines' places, so identical rows keep the
same lines; empty tables give empty tables; extra columns are ignored by
``dedup_lines`` and kept by ``without_repeats``, which also leaves out documents
that lose lines and have no word left.
"""

from __future__ import annotations

import os
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import batches, held, in_places, place, places, utf8
from tripmart.llm.components import components

EDITS = 2
MIN_CHARS = 20
#: Characters of one block of a candidate group, and postings of one packed part.
GROUP_CHARS = 1_000_000
PART_POSTINGS = 1_000_000
#: Lines of a group that are paired as they are; characters between common ends up to which lines
#: are paired by remains of deletions; lines of a group that is first cut by shared segments.
FEW, SHORT, MANY = 48, 12, 4_000
#: Windows of a line and kinds of characters counted in each.
WINDOWS, KINDS = 4, 16
#: Characters whose postings a task makes at once.
BATCH_CHARS = 1_500_000

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def name(line: str) -> bytes:
    """128 bits; the first half is what Spark's xxhash64 gives for the line."""
    raw = line.encode("utf-8", "surrogatepass")
    return xxhash.xxh64(raw, seed=42).digest()[::-1] + xxhash.xxh64(raw, seed=7).digest()


def node(line_name: bytes) -> int:
    return int.from_bytes(line_name[:8], "little", signed=True)


def node_of(line: str) -> int:
    """``node(name(line))``, without the second half of the name."""
    value = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), seed=42)
    return value - (value >> 63 << 64)


def _lines(raw: bytes | None, least: int = MIN_CHARS):
    """(number, line) of the lines of at least so many characters that are not blank."""
    if raw:
        for i, line in enumerate(raw.decode("utf-8", "replace").split("\n")):
            if len(line) >= least and line.strip(" \t\n\v\f\r"):
                yield i, line


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, line, node, name) of every line that is not blank."""
    schema = pa.schema([("doc_id", pa.int64()), ("line", pa.int32()), ("node", pa.int64()), ("name", pa.binary())])

    def run(batches_in):
        def rows():
            for batch in batches_in:
                for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    for i, line in _lines(raw, 1):
                        full = name(line)
                        yield doc_id, i, node(full), full

        yield from batches(rows(), schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, line int, node bigint, name binary")


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, length) of the EDITS + 1 segments of a line."""
    q, r = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        n = q + (i >= edits + 1 - r)
        out.append((at, n))
        at += n
    return out


def probes(length: int, edits: int = EDITS) -> list[tuple[int, int, int, int, bool]]:
    """(indexed length, segment, start, size, own) of every substring a line is posted under.

    Multi-match window: a match of segment i leaves at most i errors to its left and
    EDITS - i to its right.  The line's own segments are among them.
    """
    out = []
    for delta in range(edits + 1):
        for i, (p, n) in enumerate(segments(length - delta, edits)):
            right = edits - i
            for start in range(max(p - i, p + delta - right, 0), min(p + i, p + delta + right, length - n) + 1):
                out.append((length - delta, i, start, n, delta == 0 and start == p))
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _postings(lines: list[str], owners: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, owner) of the postings of distinct lines; the key's last bit marks a line's own segment."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    longest = int(lengths.max())
    power, unpower = _powers(_BASE, longest + 1), _powers(_UNBASE, longest + 1)
    inside = np.arange(len(chars)) - np.repeat(starts, lengths)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((chars + np.uint64(1)) * power[inside], dtype=np.uint64)))
    keys, who = [], []
    parts = edits + 1
    for delta in range(parts):
        indexed = lengths - delta
        size, rest = np.divmod(np.maximum(indexed, 0), parts)
        for i in range(parts):
            # as in ``segments``: the last ``rest`` segments are one longer
            n = size + (i >= parts - rest)
            place = i * size + np.maximum(i - (parts - rest), 0)
            right = edits - i
            for shift in range(max(-i, delta - right), min(i, delta + right) + 1):
                start = place + shift
                fits = np.flatnonzero((start >= 0) & (start <= lengths - n) & (indexed >= 0))
                s, n_, l_ = starts[fits] + start[fits], n[fits], indexed[fits].astype(np.uint64)
                h = (total[s + n_] - total[s]) * unpower[start[fits]]
                h = (h ^ ((l_ * np.uint64(131) + np.uint64(i)) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                h = h ^ (h >> np.uint64(32))
                keys.append(h & ~np.uint64(1) | np.uint64(delta == 0 and shift == 0))
                who.append(owners[fits])
    return np.concatenate(keys), np.concatenate(who)


def first_ties(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, owners, ends): lines that meet under a key are tied to its first line, if one of them
    has the key as its own segment; ``ends`` holds these ties, and of such keys only the first line's
    posting is left."""
    order = np.lexsort((owners, keys >> np.uint64(1)))
    keys, owners = keys[order], owners[order]
    group = keys >> np.uint64(1)
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(group)), bool), group[1:] != group[:-1])))
    if not len(first):
        return keys, owners, np.empty((0, 2), np.int64)
    sizes = np.diff(first, append=len(group))
    indexed = np.bitwise_or.reduceat(keys & np.uint64(1), first)
    member = np.repeat(indexed > 0, sizes)
    ends = np.column_stack((owners, np.repeat(owners[first], sizes)))[member]
    ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
    left = ~member
    left[first] = True
    marked = (group << np.uint64(1)) | np.repeat(indexed, sizes)
    return marked[left], owners[left], ends


def ties(docs: DataFrame, n_lines: int, edits: int = EDITS) -> DataFrame:
    """(a, b): nodes of lines that meet under a key, each tied to the key's first line."""
    per_line = len(probes(1000, edits))
    parts = int(min(max(16, -(-n_lines * per_line // PART_POSTINGS)), 1 << 20))
    packed = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary())])

    def post(batches_in):
        def rows():
            lines: dict[int, str] = {}
            size = 0
            for batch in batches_in:
                for raw in utf8(batch.column(0)):
                    for _, line in _lines(raw):
                        own = node_of(line)
                        if own not in lines:
                            lines[own] = line
                            size += len(line)
                    if size >= BATCH_CHARS:
                        yield from pack(lines)
                        lines, size = {}, 0
            if lines:
                yield from pack(lines)

        def pack(lines):
            keys, owners = _postings(list(lines.values()), np.fromiter(lines, np.int64, len(lines)), edits)
            keys, owners, ends = first_ties(keys, owners)
            yield from cut(ends[:, 0].view(np.uint64), ends[:, 1], -1 - np.arange(len(ends)) * parts // max(len(ends), 1))
            yield from cut(keys, owners, ((keys >> np.uint64(1)) % np.uint64(parts)).astype(np.int64))

        def cut(left, right, part):
            order = np.argsort(part, kind="stable")
            left, right, part = left[order], right[order], part[order]
            bounds = np.flatnonzero(np.diff(part, prepend=parts))
            for a, b in zip(bounds, [*bounds[1:], len(part)]):
                yield int(part[a]), left[a:b].tobytes(), right[a:b].tobytes()

        yield from batches(rows(), packed)

    edges = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(batches_in):
        def rows():
            now, keys, owners = None, [], []
            for batch in batches_in:
                for part, k, o in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if part < 0:  # tied in their batch
                        yield from zip(np.frombuffer(k, np.int64).tolist(), np.frombuffer(o, np.int64).tolist())
                        continue
                    if part != now:
                        if keys:
                            yield from tie(keys, owners)
                        now, keys, owners = part, [], []
                    keys.append(k)
                    owners.append(o)
            if keys:
                yield from tie(keys, owners)

        def tie(keys, owners):
            ends = first_ties(np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(owners), np.int64))[2]
            yield from zip(ends[:, 0].tolist(), ends[:, 1].tolist())

        yield from batches(rows(), edges, most_rows=65_536)

    return (
        docs.select("text").mapInArrow(post, "part int, keys binary, owners binary")
        .repartition("part").sortWithinPartitions("part").mapInArrow(meet, "a bigint, b bigint")
    )


def within(a: str, b: str, edits: int) -> bool:
    """Is the edit distance of two strings at most ``edits``?

    The band of 2 * edits + 1 diagonals of the distance table is kept as bits of
    differences between neighbouring cells and moves down one row a column; common
    ends are cut off first.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    if a == b:
        return True
    start, end = _common(a, b)
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    m, n = len(a), len(b)
    if m == 0:
        return n <= edits
    if m <= edits:
        # the band would start below the table: pad both with equal characters in front
        pad = "\0" * (edits + 1 - m)
        a, b = pad + a, pad + b
        m, n = len(a), len(b)
    width = 64
    full, top = (1 << width) - 1, width - 1  # bit `top` is row column + edits
    vp, vn = full & ~((1 << (top - edits)) - 1), 0
    distance = edits
    limit = 2 * edits + n - m
    for j in range(1, n + 1):
        c = b[j - 1]
        x = 0
        for i in range(max(1, j - edits), min(m, j + edits) + 1):
            if a[i - 1] == c:
                x |= 1 << (top - edits + i - j)
        d0 = ((((x & vp) + vp) & full) ^ vp) | x | vn
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        bottom = j + edits - m  # rows of the band below the table
        if bottom <= 0:
            distance += not d0 >> top & 1
            if distance > limit:
                return False
        else:
            bit = top - bottom
            distance += (hp >> bit & 1) - (hn >> bit & 1)
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
    return distance <= edits


def _common(a: str, b: str) -> tuple[int, int]:
    """Lengths of the common start and of the common end of the rest."""

    def longest(same, most):
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) // 2
            if same(mid):
                low = mid
            else:
                high = mid - 1
        return low

    most = min(len(a), len(b))
    start = longest(lambda k: a[:k] == b[:k], most)
    end = longest(lambda k: a[len(a) - k :] == b[len(b) - k :], most - start)
    return start, end


def link(lines: list[str], edits: int = EDITS) -> list[tuple[int, int]]:
    """A spanning forest of the links among lines."""
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for i, j in _meetings(list(range(len(lines))), lines, edits, root):
        a, b = root(i), root(j)
        if a != b and within(lines[i], lines[j], edits):
            parent[b] = a
            found.append((i, j))
    return found


def _counts(texts: list[str]) -> np.ndarray:
    """(window, text, kind): how often each kind of character stands in each window of the texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(len(chars)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    window = inside // max(-(-int(lengths.max()) // WINDOWS), 1)
    at = (window * len(texts) + of) * KINDS + chars % KINDS
    found = np.bincount(at, minlength=WINDOWS * len(texts) * KINDS)
    return np.minimum(found, 1 << 13).astype(np.int16).reshape(WINDOWS, len(texts), KINDS)


def _meetings(ids: list[int], texts: list[str], edits: int, root, cuts: int = 3):
    """Pairs of ids, every pair within ``edits`` that is not connected by then among them.

    Up to ``cuts`` times the lines of a large group that share a segment go on by themselves with
    the rest of their texts (a mark in the segment's place).
    """
    if len(set(map(root, ids))) < 2:
        return
    if len(ids) <= FEW:
        for (a, x), (b, y) in combinations(zip(ids, texts), 2):
            if abs(len(x) - len(y)) <= edits:
                yield a, b
        return
    start = len(os.path.commonprefix([min(texts), max(texts)]))
    ends = [t[start:][::-1] for t in texts]
    end = len(os.path.commonprefix([min(ends), max(ends)]))
    texts = [t[end:][::-1] for t in ends]
    if max(map(len, texts)) <= SHORT:
        yield from _equal_remains(ids, texts, edits, root)
    elif cuts and len(ids) > MANY:
        groups: dict[int, list[tuple[int, str, bool]]] = defaultdict(list)
        for i, t in zip(ids, texts):
            for n, part, at, size, own in probes(len(t), edits):
                if n >= 0 and at + size <= len(t):
                    groups[hash((n, part, t[at : at + size]))].append((i, t[:at] + "\uffff" + t[at + size :], own))
        while groups:
            _, members = groups.popitem()
            if len({i for i, _, _ in members}) > 1 and any(own for _, _, own in members):
                yield from _meetings([i for i, _, _ in members], [t for _, t, _ in members], edits, root, cuts - 1)
    else:
        counts = _counts(texts)
        for k in range(len(ids) - 1):
            near = np.arange(k + 1, len(ids))
            for window in counts:
                near = near[np.abs(window[near] - window[k]).sum(1) <= 2 * edits]
            for j in near.tolist():
                yield ids[k], ids[j]


def _equal_remains(ids: list[int], texts: list[str], edits: int, root):
    """Pairs of ids whose short texts are equal after up to ``edits`` deletions in each."""
    groups: dict[str, dict[int, None]] = defaultdict(dict)
    for i, t in zip(ids, texts):
        for n in range(min(edits, len(t)) + 1):
            for gone in combinations(range(len(t)), n):
                groups["".join(c for k, c in enumerate(t) if k not in gone)][i] = None
    # the longest remains first: they link most, and linked lines need no comparing
    for same in sorted(groups, key=len, reverse=True):
        members = {i: root(i) for i in groups.pop(same)}
        if len(set(members.values())) > 1:
            for a, b in combinations(members, 2):
                if members[a] != members[b]:
                    yield a, b


def links(docs: DataFrame, firsts: DataFrame, n_lines: int, edits: int = EDITS) -> DataFrame:
    """(a, b): names of linked lines, a spanning forest of the links.

    ``firsts(node, name, doc_id, line)``: where each distinct line stands first.
    """
    groups = components(ties(docs, n_lines, edits))
    members = held(firsts.join(groups, "node"))
    texts = _texts(docs, members)
    sized = texts.groupBy("label").agg(F.ceil(F.sum(F.char_length("text")) / GROUP_CHARS).alias("blocks"))
    placed = texts.join(sized, "label").withColumn("block", F.pmod(F.xxhash64("name"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    pairs = (
        placed.withColumn("other", other)
        .select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "name", "text")
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def verify(batches_in):
        def groups_():
            key, own = None, {}
            for batch in batches_in:
                for k, line_name, raw in zip(
                    zip(*(batch.column(i).to_pylist() for i in range(3))), batch.column(3).to_pylist(),
                    utf8(batch.column(4)),
                ):
                    if k != key:
                        yield own
                        key, own = k, {}
                    own[line_name] = raw.decode("utf-8", "replace")
            yield own

        def rows():
            for own in groups_():
                names = list(own)
                for i, j in link(list(own.values()), edits):
                    yield names[i], names[j]

        yield from batches(rows(), schema)

    keys = ["label", "i", "j"]
    return pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(verify, "a binary, b binary")


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(label, name, text) of the first occurrences in ``members``."""
    known = docs.sparkSession.sparkContext.broadcast(np.packbits(places(members, "node")))  # fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("line", pa.int32()), ("name", pa.binary()), ("text", pa.string())])

    def run(batches_in):
        marked = np.unpackbits(known.value)

        def rows():
            for batch in batches_in:
                for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    for i, line in _lines(raw):
                        if marked[place(node_of(line))]:
                            yield doc_id, i, name(line), line

        yield from batches(rows(), schema)

    near = in_places(docs.select("doc_id", "text"), "doc_id", places(members, "doc_id"))
    lines = near.mapInArrow(run, "doc_id bigint, line int, name binary, text string")
    return lines.join(members.select("doc_id", "line", "name", "label"), ["doc_id", "line", "name"]).select(
        "label", "name", "text"
    )


def repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """(doc_id, lines, n_exact, n_near): the lines of each document that go.

    ``lines`` holds (line, node); n_near counts those whose class began with another text.
    """
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    found = held(occurrences(docs))
    names = held(
        found.groupBy("node", "name")
        .agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    firsts = names.select("node", "name", "first.doc_id", "first.line")
    classes = components(links(docs, firsts, names.count(), edits)).withColumnRenamed("node", "name")
    linked = names.join(classes, "name")
    heads = linked.groupBy("label").agg(F.min("first").alias("head"))
    keep = (
        names.join(linked.join(heads, "label").select("name", "head"), "name", "left")
        .where("n > 1 OR head IS NOT NULL")
        .select("name", "first", F.coalesce("head", "first").alias("head"))
    )
    gone = found.join(keep, "name").where(F.struct("doc_id", "line") != F.col("head"))
    return gone.groupBy("doc_id").agg(
        F.collect_set(F.struct("line", "node")).alias("lines"),
        F.count_if(F.col("head") == F.col("first")).alias("n_exact"),
        F.count_if(F.col("head") != F.col("first")).alias("n_near"),
    )


def _without(df: DataFrame, edits: int) -> DataFrame:
    """``df`` with the shortened text, and what went as the struct column ``__gone``."""
    gone = repeats(df, edits).select(F.col("doc_id").alias("__id"), F.struct("lines", "n_exact", "n_near").alias("__gone"))

    @F.arrow_udf("string")
    def left(text: pa.Array, lines: pa.Array) -> pa.Array:
        def rest(raw, lost):
            out = {(x["line"], x["node"]) for x in lost}
            at = {k for k, _ in out}
            every = enumerate(raw.decode("utf-8", "replace").split("\n"))
            return "\n".join(x for k, x in every if k not in at or (k, node_of(x)) not in out)

        return pa.array([None if raw is None else rest(raw, lost.as_py()) for raw, lost in zip(utf8(text), lines)], pa.string())

    lost = F.col("__gone").isNotNull()
    text = F.when(lost, left(F.when(lost, F.col("text")), F.col("__gone.lines"))).otherwise(F.col("text"))
    joined = df.join(gone, df["doc_id"] == F.col("__id"), "left").drop("__id")
    return joined.withColumn("text", text)


def dedup_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """(doc_id, n_lines, n_exact, n_near, text) of each row: what went, and the text left."""
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines")
    rows = docs.select("doc_id", "text", n_lines)
    none = F.lit(0).cast("long")
    return _without(rows, edits).select(
        "doc_id", "n_lines", F.coalesce("__gone.n_exact", none).alias("n_exact"),
        F.coalesce("__gone.n_near", none).alias("n_near"), "text",
    )


def without_repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The rows of ``docs`` with shortened texts; a text left without a word goes."""
    left = _without(docs, edits)
    return left.where(F.col("__gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop("__gone")
