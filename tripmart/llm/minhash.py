"""MinHash near-dedup by an inverted join over signature coordinates.

1. Every text becomes its set of hashed word shingles; equal sets are one node.
2. A node's signature has ``COORDINATES`` minima.  Nodes are posted under each
   (coordinate, value) pair; pairs that a single node holds are dropped.
3. Two nodes with ``MATCHES`` equal coordinates share a posting among the rarest
   m - MATCHES + 1 of their m remaining ones, so only those (the prefix) are
   merged; the long lists are skipped and counted straight from the signatures.
4. Inside a list every node is compared with the list's leaders and tied to those
   that share enough coordinates, which gives candidate groups without emitting
   all pairs.  Lists longer than ``BLOCK`` are cut into blocks; the leaders of the
   blocks then meet, every pair of them, again in blocks.
5. Each candidate group's full sets come together once, groups of more than
   ``GROUP_SHINGLES`` shingles as pairs of blocks, and links are confirmed exactly.

Step 3 misses a pair at the threshold with a probability below 1e-7 (the lower binomial
tail of COORDINATES trials; ``matches_for`` takes the most equal coordinates that keep
it there, ``MATCHES`` at 0.85).  Step 4 misses none: a node stops
being compared only once it shares ``NEAR`` coordinates with a leader; a partner
that shares ``MATCHES`` with it differs from that leader in at most
(COORDINATES - NEAR) + (COORDINATES - MATCHES) coordinates, and so many still tie
it to the leader.  Partners in different blocks may each have such a leader, so two
leaders are tied at (COORDINATES - NEAR) equal coordinates less, and none of them stops
being compared.  Tying too much only costs time, since links are confirmed.

Defined results: texts that are null, empty or without words have an empty set and
link with nothing; rows with a null doc_id link with nothing, have a null component
and are kept; rows that repeat a doc_id are members like any other; an empty table
gives an empty table; extra columns are ignored, and kept by ``keep_first``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import batches, held, in_places, places, utf8
from tripmart.llm.components import components

WIDTH = 3
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
COORDINATES, MATCHES, NEAR = 48, 26, 40
TIE = NEAR + MATCHES - COORDINATES
#: Probability of missing a pair at the threshold stays below this.
MISS = 1e-7
BLOCK = 4096
GROUP_SHINGLES = 500_000
#: Sets whose signature is taken at once: so many, or so many shingles and one set more.
SKETCH_SETS, SKETCH_SHINGLES = 256, 100_000

_MIX = np.random.default_rng(20240229).integers(1, 1 << 63, (2, COORDINATES), dtype=np.uint64) | np.uint64(1)
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                    0x85EBCA77C2B2AE63], np.uint64)


def matches_for(percent: int) -> int:
    """The most equal coordinates to ask for that miss a pair at the threshold below ``MISS``."""
    t = percent / 100
    missed, m = (1 - t) ** COORDINATES, 0
    while m < COORDINATES and missed < MISS:
        m += 1
        missed += math.comb(COORDINATES, m) * t**m * (1 - t) ** (COORDINATES - m)
    if m + NEAR <= COORDINATES:
        raise ValueError(f"{COORDINATES} coordinates are too few for a threshold of {percent} %")
    return m


class _Words(dict):
    """Hash of each word met; forgets when it grows past its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(raw: bytes | None, words: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes: ASCII letters lowered, words between ASCII white space."""
    found = (raw or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = min(width, len(h))
    mixed = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        mixed = mixed * _POWERS[0] + _scramble(h[i : len(h) - n + 1 + i] ^ _POWERS[1 + i % 4])
    return np.unique(_scramble(mixed))


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES minima (32 bits) of each non-empty set."""
    out = np.empty((len(sets), COORDINATES), np.uint32)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    for k in range(COORDINATES):
        v = (flat ^ _MIX[0, k]) * _MIX[1, k]
        v = (v ^ (v >> np.uint64(32))) * _MIX[0, k]
        out[:, k] = np.minimum.reduceat(v >> np.uint64(32), starts)
    return out


def _parts(rows, words: dict, width: int):
    """(id, set) of (id, text) in lists of bounded size."""
    part, size = [], 0
    for doc_id, raw in rows:
        part.append((doc_id, shingles(raw, words, width)))
        size += len(part[-1][1])
        if len(part) >= SKETCH_SETS or size >= SKETCH_SHINGLES:
            yield part
            part, size = [], 0
    if part:
        yield part


def sketch(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, node, sig) of each row; node (128 bits) names the set, null if empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                        ("sig", pa.binary())])

    def run(batches_in):
        words = _Words()

        def rows():
            for batch in batches_in:
                for part in _parts(zip(batch.column(0).to_pylist(), utf8(batch.column(1))), words, width):
                    full = [s for _, s in part if len(s)]
                    sigs = iter(signature(full) if full else ())
                    for doc_id, s in part:
                        if len(s):
                            yield doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), next(sigs).tobytes()
                        else:
                            yield doc_id, 0, None, None

        yield from batches(rows(), schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, node binary, sig binary"
    )


def _tokens(nodes: DataFrame) -> DataFrame:
    """(token, node) for each coordinate; a token is the coordinate's place and value."""
    schema = pa.schema([("token", pa.int64()), ("node", pa.binary())])
    place = np.arange(COORDINATES, dtype=np.int64) << 32

    def run(batches_in):
        for batch in batches_in:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            token = (sig.astype(np.int64) + place).ravel()
            node = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), COORDINATES)))
            for a in range(0, len(token), 65_536):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[a : a + 65_536]), node[a : a + 65_536]], schema=schema
                )

    return nodes.select("node", "sig").mapInArrow(run, "token bigint, node binary")


def prefixes(nodes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(token, n, node, mark): the postings to merge; n nodes hold the token, mark is
    one byte for each coordinate."""
    tokens = _tokens(nodes)
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = tokens.join(common, "token")
    entry = F.struct("n", "token")
    chosen = (
        shared.groupBy("node").agg(F.sort_array(F.collect_list(entry)).alias("held"))  # at most COORDINATES
        .where(F.size("held") >= matches)
        .select("node", F.explode(F.slice("held", F.lit(1), F.size("held") - (matches - 1))).alias("p"))
    )
    return chosen.join(nodes.select("node", "sig"), "node").select("p.token", "p.n", "node", "sig")


def _marks(sigs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint32).reshape(-1, COORDINATES)


def _tie(nodes: list, sigs: np.ndarray, tie: int = TIE, near: int = NEAR):
    """Ties among the members of one list, each to the smallest of its group, and the
    places of the list's leaders: members that share ``near`` with no earlier leader."""
    group = np.arange(len(nodes))
    leaders = []
    rest = group.copy()
    while len(rest):
        lead, rest = rest[0], rest[1:]
        leaders.append(lead)  # it has met all earlier leaders already
        equal = (sigs[rest] == sigs[lead]).sum(1)
        met = np.unique(group[rest[equal >= tie]])
        if len(met):
            group[np.isin(group, met)] = group[lead]
        rest = rest[equal < near]
    members: dict[int, list] = {}
    for node, g in zip(nodes, group.tolist()):
        members.setdefault(g, []).append(node)
    edges = []
    for own in members.values():
        head = min(own)
        edges += [(node, head) for node in own if node != head]
    return edges, leaders


def _merge_lists(postings: DataFrame, keys: list[str], tie: int = TIE, near: int = NEAR) -> DataFrame:
    """(a, b, token): ties inside each list; rows without b are the leaders of their list."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("token", pa.int64()), ("sig", pa.binary()),
                        ("more", pa.bool_())])
    by = [F.col(k) for k in keys]

    def run(batches_in):
        def lists():
            key, nodes, sigs, more = None, [], [], False
            for batch in batches_in:
                *ks, node, sig, cut = (c.to_pylist() for c in batch.columns)
                for row in zip(zip(*ks), node, sig, cut):
                    if row[0] != key:
                        if nodes:
                            yield key, nodes, sigs, more
                        key, nodes, sigs = row[0], [], []
                    nodes.append(row[1])
                    sigs.append(row[2])
                    more = row[3]
            if nodes:
                yield key, nodes, sigs, more

        def rows():
            for key, nodes, sigs, more in lists():
                if len(nodes) == 1 and not more:
                    continue
                edges, leaders = _tie(nodes, _marks(sigs), tie, near)
                for a, b in edges:
                    yield a, b, None, None, None
                if more:
                    for i in leaders:
                        yield nodes[i], None, key[0], sigs[i], True

        yield from batches(rows(), schema)

    return (
        postings.select(*by, "node", "sig", "more").repartition(*by).sortWithinPartitions(*keys, "node")
        .mapInArrow(run, "a binary, b binary, token bigint, sig binary, more boolean")
    )


def candidates(nodes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(a, b): ties whose components hold every pair of nodes with enough equal coordinates."""
    tie = NEAR + matches - COORDINATES
    blocks = F.ceil(F.col("n") / BLOCK)
    first = held(_merge_lists(
        prefixes(nodes, matches).withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("more", blocks > 1),
        ["token", "block"], tie,
    ))
    # leaders of lists that were cut meet each other, all pairs of their blocks
    leaders = first.where("b IS NULL").select("token", F.col("a").alias("node"), "sig")
    sizes = leaders.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = leaders.join(sizes, "token").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks"))
    second = _merge_lists(
        _block_pairs(placed).withColumn("more", F.lit(False)), ["token", "i", "j"],
        tie - (COORDINATES - NEAR), COORDINATES + 1,
    )
    return first.where("b IS NOT NULL").select("a", "b").unionByName(second.select("a", "b"))


def _block_pairs(placed: DataFrame) -> DataFrame:
    """Rows with (i, j), i <= j: a row of ``block`` goes to every pair that holds it."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    return (
        placed.withColumn("other", other)
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .drop("other")
    )


def _confirm(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the exact links among sets."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(1, 0)] if 100 * both >= percent * (lengths.sum() - both) else []
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    flat = flat.astype(np.int32)  # at most two blocks of GROUP_SHINGLES, and a set more in each
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    label = np.arange(n)
    done = np.zeros(n, bool)
    links = []
    mark = np.zeros(len(vocabulary), np.int32)
    while True:
        # pairs inside one component need no test; those with a tested set are done
        open_ = label[~done]
        if not len(open_) or (open_ == open_[0]).all():
            return links
        counts = np.bincount(open_, minlength=n)
        at = int(np.flatnonzero(~done & (label != counts.argmax()))[0])
        own = flat[starts[at] : starts[at] + lengths[at]]
        mark[own] = 1
        both = np.add.reduceat(mark[flat], starts)
        mark[own] = 0
        near = 100 * both >= percent * (lengths + lengths[at] - both)
        for i in np.flatnonzero(near & (label != label[at])):
            if label[i] != label[at]:
                links.append((int(i), at))
                label[label == label[i]] = label[at]
        done[at] = True


def confirmed(
    docs: DataFrame, nodes: DataFrame, groups: DataFrame, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """(a, b): exact links, a spanning forest of them inside each candidate group.

    ``nodes(node, first_id, n_shingles)``, ``groups(node, label)``.
    """
    members = held(groups.join(nodes.select("node", "first_id", "n_shingles"), "node"))
    blocks = (
        members.groupBy("label").agg(F.ceil(F.sum("n_shingles") / GROUP_SHINGLES).alias("blocks"))
    )
    placed = members.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    wanted = placed.select(F.col("first_id").alias("doc_id"), "node", "label", "block", "blocks")
    texts = in_places(docs.select("doc_id", "text"), "doc_id", places(members, "first_id"))
    found = texts.join(wanted, "doc_id").select("text", "node", "label", "block", "blocks")

    out = pa.schema([("node", pa.binary()), ("label", pa.binary()), ("block", pa.int64()), ("blocks", pa.int64()),
                     ("hashes", pa.binary())])

    def sets(batches_in):
        words = _Words()

        def rows():
            for batch in batches_in:
                for raw, node, label, block, blocks_ in zip(
                    utf8(batch.column(0)), *(batch.column(i).to_pylist() for i in range(1, 5))
                ):
                    found_ = shingles(raw, words, width).tobytes()
                    if xxhash.xxh3_128_digest(found_) == node:  # another text of the same id is not this node
                        yield node, label, block, blocks_, found_

        yield from batches(rows(), out)

    ready = _block_pairs(found.mapInArrow(sets, "node binary, label binary, block bigint, blocks bigint, hashes binary"))
    links = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def confirm(batches_in):
        def groups_():
            key, own = None, {}
            for batch in batches_in:
                for k, node, hashes in zip(
                    zip(*(batch.column(i).to_pylist() for i in range(3))), batch.column(3).to_pylist(),
                    utf8(batch.column(4)),
                ):
                    if k != key:
                        if len(own) > 1:
                            yield own
                        key, own = k, {}
                    own[node] = np.frombuffer(hashes, np.uint64)
            if len(own) > 1:
                yield own

        def rows():
            for own in groups_():
                names = list(own)
                for i, j in _confirm(list(own.values()), percent):
                    yield names[i], names[j]

        yield from batches(rows(), links)

    keys = ["label", "i", "j"]
    return (
        ready.select(*keys, "node", "hashes").repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(confirm, "a binary, b binary")
    )


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; linked at ``percent`` of shared shingles."""
    rows = held(sketch(docs, width))
    linked = rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = held(
        linked.groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.any_value("sig").alias("sig"), F.any_value("n_shingles").alias("n_shingles"))
    )
    groups = components(candidates(nodes, matches_for(percent)))
    classes = components(confirmed(docs, nodes, groups, width, percent))
    named = nodes.join(classes, "node").select("node", "label", "first_id")
    heads = named.groupBy("label").agg(F.min("first_id").alias("head"))
    joined = named.join(heads, "label").select("node", "head")
    final = nodes.select("node", "first_id").join(joined, "node", "left").select(
        "node", F.coalesce("head", "first_id").alias("head")
    )
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("head", "doc_id"))
    return (
        rows.select("doc_id", "n_shingles", "node").join(final, "node", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one for each component, with all their columns.

    Of rows that repeat a doc_id the one with the smallest text hash stays, if any does.
    """
    found = near_duplicates(docs, width, percent).where("doc_id IS NOT NULL")
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("__kept")).where("NOT __kept").select(
        F.col("doc_id").alias("__gone")
    )
    own = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    stay = (
        docs.where("doc_id IS NOT NULL").join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
        .withColumn("__turn", F.row_number().over(own)).where("__turn = 1").drop("__turn")
    )
    return stay.unionByName(docs.where("doc_id IS NULL"))
