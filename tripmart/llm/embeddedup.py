"""Embedding near-dedup by a PCA-ordered tiled comparison.

1. Vectors become unit vectors in double precision; equal vectors are one node with a
   weight, so groups of copies are never compared with each other.
2. The axes are those of all unit vectors' second moments, strongest first: partial
   sums in the tasks, one matrix of (length x length) for each length of vectors.
3. Nodes are ordered by cells of their leading coordinates (a range sort) and cut into
   tiles of about ``TILE_BYTES``.  Two unit vectors at the threshold are at most
   sqrt(2 - 2 * threshold) apart, so tiles whose boxes of leading coordinates are farther
   apart never meet; tiles find each other by the cells of the first coordinate.
4. Where two tiles meet, products are accumulated over the leading dimensions first.
   What the other dimensions can add is at most the product of the suffix norms; a
   pair stops as soon as the sum of both cannot reach the threshold.  The tile gives
   one row for each node that found a partner: the weight of its partners, and a tie to
   the head of its group in this pair of tiles.  No pair of vectors is written.
5. Ties give components (rounds that keep one edge per node).

Defined results: null, empty and zero vectors, those with null or non-finite components,
and rows without an id link with nothing; vectors of different lengths neither.  Equal
vectors link with each other whatever the rounding of their cosine.  Rows
that repeat an id are vectors like any other; a row without an id has a null component
and is kept; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import batches, held, positions
from tripmart.llm.components import components

THRESHOLD = 0.95
#: Bytes of a tile's vectors; two of them and the products of one step are in memory at once.
TILE_BYTES = 4 << 20
#: Products of a step: rows of one tile against all of the other.
STEP_PRODUCTS = 2 << 20
#: Leading coordinates that order the tiles and bound their boxes.
LEADING = 4
#: Below this share of open pairs, they are followed one by one instead of as a matrix.
SPARSE = 0.05
#: Bounds must not drop a pair by rounding; products this near the threshold are summed again in plain order.
SLACK = 1e-9


def unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector at length 1, or None if it links with nothing."""
    if not len(vector) or not np.isfinite(vector).all():
        return None
    top = np.abs(vector).max()
    if top == 0:
        return None
    vector = vector / top  # squares neither overflow nor vanish
    return vector / math.sqrt(float((vector * vector).sum()))


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, n, v) of each row: the vector's name (128 bits), length and unit vector, null if it takes no part."""
    schema = pa.schema([("vec_id", pa.int64()), ("node", pa.binary()), ("n", pa.int32()), ("v", pa.binary())])

    def run(batches_in):
        def rows():
            for batch in batches_in:
                lists = batch.column(1)
                for vec_id, vector in zip(batch.column(0).to_pylist(), lists):
                    values = vector.values if vector.is_valid else None
                    v = None
                    if vec_id is not None and values is not None and not values.null_count:
                        raw = values.to_numpy(zero_copy_only=False) + 0.0  # -0.0 is 0.0
                        v = unit(raw)
                    if v is None:
                        yield vec_id, None, None, None
                    else:
                        yield vec_id, xxhash.xxh3_128_digest(raw.tobytes()), len(v), v.tobytes()

        yield from batches(rows(), schema)

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).mapInArrow(
        run, "vec_id bigint, node binary, n int, v binary"
    )


def _matrices(batches_in, at_n: int, at_v: int):
    """(batch, rows of one length, their matrix) of Arrow batches with a length and a vector column."""
    for batch in batches_in:
        lengths = batch.column(at_n).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            raw = batch.column(at_v).take(pa.array(at)).to_pylist()
            yield batch, at, np.frombuffer(b"".join(raw), np.float64).reshape(len(at), int(n))


def axes(nodes: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors the orthogonal axes of ``nodes(n, v)``, strongest first.

    The driver gets one triangle of sums for each length, whatever the number of rows.
    """
    schema = pa.schema([("n", pa.int32()), ("at", pa.int32()), ("x", pa.float64())])

    def run(batches_in):
        sums: dict[int, np.ndarray] = {}
        for _, _, m in _matrices(batches_in, 0, 1):
            n = m.shape[1]
            sums[n] = sums.get(n, 0) + m.T @ m
        for n, s in sums.items():
            x = s[np.triu_indices(n)]
            for a in range(0, len(x), 65_536):
                part = x[a : a + 65_536]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), n, np.int32)), pa.array(np.arange(a, a + len(part), dtype=np.int32)), pa.array(part)],
                    schema=schema,
                )

    sums = nodes.select("n", "v").mapInArrow(run, "n int, at int, x double").groupBy("n", "at").agg(F.sum("x").alias("x"))
    found = sums.orderBy("n", "at").toArrow()
    lengths, x = found.column("n").to_numpy(), found.column("x").to_numpy()
    out = {}
    for n in np.unique(lengths).tolist():
        s = np.zeros((n, n))
        s[np.triu_indices(n)] = x[lengths == n]
        s = s + np.triu(s, 1).T
        out[n] = np.linalg.eigh(s)[1][:, ::-1].copy()
    return out


def levels(n: int) -> list[int]:
    """Ends of the runs of dimensions that are accumulated one after the other."""
    return sorted({max(1, n // 8), max(1, n // 4), max(1, n // 2), n})


class Tile:
    """Unit vectors of one length, turned to the axes, with the norms of their suffixes."""

    def __init__(self, plain: np.ndarray, turn: np.ndarray):
        self.plain = plain
        self.turned = plain @ turn
        squares = self.turned * self.turned
        self.rest = [np.sqrt(squares[:, e:].sum(1)) for e in levels(plain.shape[1])]

    def __len__(self):
        return len(self.plain)


def reaching(a: Tile, b: Tile, threshold: float, same: bool = False):
    """(rows of a, rows of b) of the pairs with a cosine of at least the threshold, step by step.

    ``same``: both are one tile; each pair comes once, without a row's pair with itself.
    """
    ends = levels(a.plain.shape[1])
    low = threshold - SLACK
    step = max(1, STEP_PRODUCTS // max(1, len(b)))
    for first in range(0, len(a), step):
        rows = slice(first, min(first + step, len(a)))
        product = q = None
        start = 0
        for end, rest_a, rest_b in zip(ends, a.rest, b.rest):
            if q is None:
                part = a.turned[rows, start:end] @ b.turned[:, start:end].T
                product = part if product is None else product + part
                open_ = product + rest_a[rows, None] * rest_b >= low
                if same:
                    open_ &= np.arange(rows.start, rows.stop)[:, None] < np.arange(len(b))
                if end == ends[-1] or np.count_nonzero(open_) <= SPARSE * open_.size:
                    q, c = np.nonzero(open_)
                    product = product[q, c]
                    q = q + first
            else:
                kept = []
                for s in range(0, len(q), 65_536):
                    qs, cs = q[s : s + 65_536], c[s : s + 65_536]
                    p = product[s : s + 65_536] + np.einsum("ij,ij->i", a.turned[qs, start:end], b.turned[cs, start:end])
                    keep = p + rest_a[qs] * rest_b[cs] >= low
                    kept.append((qs[keep], cs[keep], p[keep]))
                if kept:
                    q, c, product = (np.concatenate(x) for x in zip(*kept))
            start = end
            if q is not None and not len(q):
                break
        if q is None or not len(q):
            continue
        close = np.flatnonzero(product < threshold + SLACK)
        for s in range(0, len(close), 65_536):
            at = close[s : s + 65_536]
            product[at] = (a.plain[q[at]] * b.plain[c[at]]).sum(1)
        linked = product >= threshold
        yield q[linked], c[linked]


def _merge(label: np.ndarray, q: np.ndarray, c: np.ndarray) -> None:
    """Give the ends of each pair one label; q ascending."""
    starts = np.flatnonzero(np.diff(q, prepend=-1))
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(q)]):
        met = label[c[s:e]]
        own = label[q[s]]
        if (met != own).any():
            together = np.unique(np.append(met, own))
            label[np.isin(label, together)] = together[0]


def compared(a: Tile, b: Tile, weight_a, weight_b, threshold: float, same: bool):
    """(partners of a's rows, of b's rows, labels of both in a row): weights of linked rows and groups."""
    n = len(a)
    shift = 0 if same else n
    found_a, found_b = np.zeros(n, np.int64), np.zeros(len(b), np.int64)
    label = np.arange(n + (0 if same else len(b)))
    for q, c in reaching(a, b, threshold, same):
        np.add.at(found_a, q, weight_b[c])
        np.add.at(found_b, c, weight_a[q])
        _merge(label, q, c + shift)
    return found_a, found_b, label


def tiles(nodes: DataFrame, turns: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """``nodes`` with their ``tile`` and the leading coordinates ``x0``.. by which tiles are boxed."""
    wide = math.sqrt(2 - 2 * threshold) or 1e-6
    names = [f"x{i}" for i in range(LEADING)]
    schema = pa.schema([("node", pa.binary()), ("w", pa.int64()), ("n", pa.int32()), ("v", pa.binary())]
                       + [(c, pa.float64()) for c in names])
    known = nodes.sparkSession.sparkContext.broadcast({n: t[:, :LEADING].copy() for n, t in turns.items()})

    def run(batches_in):
        for batch, at, m in _matrices(batches_in, 2, 3):
            x = np.zeros((len(m), LEADING))
            lead = m @ known.value[m.shape[1]]
            x[:, : lead.shape[1]] = lead
            mine = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*(mine.column(i) for i in range(4)), *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(LEADING))],
                schema=schema,
            )

    placed = nodes.select("node", "w", "n", "v").mapInArrow(
        run, "node binary, w bigint, n int, v binary, " + ", ".join(f"{c} double" for c in names)
    )
    cells = [F.floor(F.col(c) / wide) for c in names]
    at = positions(placed, "n", *cells, "node")
    starts = F.broadcast(at.groupBy("n").agg(F.min("position").alias("__from")))  # one row for each length, as in ``turns``
    size = F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES) / (8 * F.col("n"))))
    return (
        at.join(starts, "n")
        .withColumn("tile", F.floor((F.col("position") - F.col("__from")) / size).cast("long")).drop("position", "__from")
    )


def meetings(tiled: DataFrame, threshold: float) -> DataFrame:
    """(n, i, j), i <= j: the pairs of tiles whose boxes are near enough for a link."""
    wide = math.sqrt(2 - 2 * threshold) + SLACK
    names = [f"x{i}" for i in range(LEADING)]
    boxes = held(tiled.groupBy("n", "tile").agg(
        *[F.min(c).alias(f"lo_{c}") for c in names], *[F.max(c).alias(f"hi_{c}") for c in names]
    ))
    # a tile is in every cell of the first coordinate that its box, widened, touches: a few
    cell = lambda x: F.floor(x / wide)
    left = boxes.select("n", F.col("tile").alias("i"), *[F.col(f"{s}_{c}").alias(f"a{s}_{c}") for c in names for s in ("lo", "hi")],
                        F.explode(F.sequence(cell(F.col("lo_x0") - wide), cell(F.col("hi_x0") + wide))).alias("cell"))
    right = boxes.select("n", F.col("tile").alias("j"), *[F.col(f"{s}_{c}").alias(f"b{s}_{c}") for c in names for s in ("lo", "hi")],
                         F.explode(F.sequence(cell(F.col("lo_x0")), cell(F.col("hi_x0")))).alias("cell"))
    gap = F.lit(0.0)
    for c in names:
        g = F.greatest(F.lit(0.0), F.col(f"alo_{c}") - F.col(f"bhi_{c}"), F.col(f"blo_{c}") - F.col(f"ahi_{c}"))
        gap = gap + g * g
    near = left.join(right, ["n", "cell"]).where((F.col("i") <= F.col("j")) & (gap <= wide * wide))
    return near.select("n", "i", "j").distinct()


def met(tiled: DataFrame, pairs: DataFrame, turns: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(node, links, head): what each node found in each pair of tiles where it found anything."""
    known = tiled.sparkSession.sparkContext.broadcast(turns)
    schema = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("head", pa.binary())])
    sides = pairs.select("n", "i", "j", F.explode(F.expr("if(i = j, array(i), array(i, j))")).alias("tile"))
    rows = tiled.select("n", "tile", "node", "w", "v").join(sides, ["n", "tile"])

    def run(batches_in):
        def sides_():
            """(key, sides by tile) of one pair of tiles after the other."""
            key, sides = None, {}
            for batch in batches_in:
                cell = np.column_stack([batch.column(i).to_numpy() for i in range(4)]).astype(np.int64)
                bounds = np.flatnonzero((np.diff(cell, axis=0, prepend=-1) != 0).any(1))
                for s, e in zip(bounds.tolist(), [*bounds[1:].tolist(), batch.num_rows]):
                    n, i, j, tile = cell[s].tolist()
                    if (n, i, j) != key:
                        if key:
                            yield key, sides
                        key, sides = (n, i, j), {}
                    own = sides.setdefault(tile, ([], [], []))
                    own[0].extend(batch.column(4).slice(s, e - s).to_pylist())
                    own[1].append(batch.column(5).slice(s, e - s).to_numpy())
                    own[2].append(b"".join(batch.column(6).slice(s, e - s).to_pylist()))
            if key:
                yield key, sides

        def found():
            for (n, i, j), sides in sides_():
                if len(sides) < (1 if i == j else 2):
                    continue
                turn = known.value[n]
                a, b = (Tile(np.frombuffer(b"".join(sides[t][2]), np.float64).reshape(-1, n), turn) for t in (i, j))
                names = sides[i][0] + (sides[j][0] if i != j else [])
                links_a, links_b, label = compared(
                    a, b, np.concatenate(sides[i][1]), np.concatenate(sides[j][1]), threshold, i == j
                )
                links = links_a + links_b if i == j else np.concatenate((links_a, links_b))
                for at in np.flatnonzero(links).tolist():
                    yield names[at], int(links[at]), names[label[at]]

        yield from batches(found(), schema)

    keys = ["n", "i", "j", "tile"]
    return (
        rows.repartition("n", "i", "j").sortWithinPartitions(*keys).select(*keys, "node", "w", "v")
        .mapInArrow(run, "node binary, links bigint, head binary")
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row."""
    rows = held(prepared(vectors))
    nodes = held(
        rows.where("node IS NOT NULL").groupBy("node")
        .agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("first_id"), F.first("n").alias("n"), F.first("v").alias("v"))
    )
    turns = axes(nodes)
    tiled = held(tiles(nodes, turns, threshold))
    found = held(met(tiled, meetings(tiled, threshold), turns, threshold))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("head").alias("b")))
    named = nodes.select("node", "w", "first_id").join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = named.groupBy("label").agg(F.min("first_id").alias("head"))
    of_node = named.join(heads, "label").join(links, "node", "left").select(
        "node", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "head"
    )
    # rows that take no part have no node and would meet in one task of a join
    linked = rows.where("node IS NOT NULL").select("vec_id", "node").join(of_node, "node").select(
        "vec_id", "n_links", F.col("head").alias("component_id")
    )
    alone = rows.where("node IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
