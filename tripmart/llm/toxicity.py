"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one learned from toxic and one from ordinary
training texts, share their backoff: the probability of a character after a
context of its class falls back on continuation counts pooled over both classes,
so an expression that is rare in one class is smoothed by how its parts behave in
all texts.  A word's evidence is the log-likelihood ratio of the two models; a
text's is that ratio normalised by length, over the whole text (mean) and over its
most toxic passage of ``PASSAGE`` words (peak).  A logistic fit turns both into a
score.  It is fitted on at most ``FIT_ROWS`` training rows that a second pair of
models has not seen; the counts cover every training row.

Every counted character sequence is in the models.  Up to ``MODEL_GRAMS`` of them are
fitted on the driver and sent to executors; more stay tables: the same values come
from joins and aggregations, texts are dealt into blocks, and each block's sequences
are joined with the tables and come back to its texts.

Defined results: a null text is the empty text, and empty texts get the score of
no evidence; label rows with a null id or a null label are ignored and of several
labels of an id the highest counts; rows that repeat a doc_id are scored alone and
all count in training; without training rows of both labels every score is 0;
empty tables give empty tables; extra columns are ignored or passed through.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import held, utf8

ORDER = 5
DISCOUNT = 0.75
PASSAGE = 3
MODEL_GRAMS = 2_000_000
FIT_ROWS = 20_000
#: Characters of one block of texts that meets the values of its sequences.
BLOCK_CHARS = 8_000_000
THRESHOLD = 0.3
#: Words and memo entries held at once by a Python worker.
HELD_WORDS = 400_000
START, END = "\x02", "\x03"
STRIP = "\"'.,;:!?()[]{}<>*#%&$-_/\\…«»„“”"


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def normal(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(STRIP)


def _step(key: np.ndarray, char: np.ndarray) -> np.ndarray:
    key = (key ^ (char.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(29))


def _keys(chars: np.ndarray) -> np.ndarray:
    """Keys of rows of characters; leading zeros stand for no character."""
    key = np.zeros(len(chars), np.uint64)
    for column in chars.T:
        key = np.where(column > 0, _step(key, column), key)
    return key


@dataclass
class Model:
    """Log-likelihood ratios of known sequences, and of the backoff of known contexts."""

    grams: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    ratios: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))
    contexts: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    backoffs: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))

    def words(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio of each word."""
        if not words:
            return np.empty(0)
        chars, starts, inside, context, gram = _places(words)
        value = _lookup(self.contexts, self.backoffs, context)
        at = np.searchsorted(self.grams, gram)
        known = np.zeros(len(chars), bool)
        if len(self.grams):
            at = np.minimum(at, len(self.grams) - 1)
            known = self.grams[at] == gram
            value = np.where(known, self.ratios[at], value)
        value[inside == 0] = 0.0
        return np.add.reduceat(value, starts)


@dataclass
class Tables:
    """A model as tables (key, value) of all its sequences and contexts."""

    grams: DataFrame
    contexts: DataFrame


def _places(words: list[str]) -> tuple[np.ndarray, ...]:
    """Characters of words, where each word starts, and for each character its place in
    the word and the keys of its context and of its sequence."""
    text = "".join(START + w + END for w in words)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    inside = np.arange(len(chars)) - np.repeat(starts, lengths)
    context = np.zeros(len(chars), np.uint64)
    for back in range(ORDER - 1, 0, -1):
        there = inside >= back
        moved = np.concatenate((np.zeros(min(back, len(chars)), np.uint32), chars[:-back]))[: len(chars)]
        context = np.where(there, _step(context, moved), context)
    return chars, starts, inside, context, _step(context, chars)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float = 0.0) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at].astype(float), default)


def _sums(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, *(np.bincount(inverse, w, len(unique)) for w in weights)


def _shared(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and probabilities of the pooled continuation model for the suffixes of ``chars``."""
    used = (chars > 0).sum(1)
    width = chars.shape[1]
    levels = []
    above = np.empty((0, width), chars.dtype)
    for n in range(width, 1, -1):
        # the kinds of n characters: those counted, and what the longer kinds end in
        layer = np.concatenate((chars[used == n], above))
        _, first = np.unique(_keys(layer), return_index=True)
        cut = layer[first]
        cut[:, width - n] = 0  # without the oldest character
        _, first, count = np.unique(_keys(cut), return_index=True, return_counts=True)
        above = cut[first]
        levels.append((above, count.astype(float)))
    rows = np.concatenate([c for c, _ in levels])
    counts = np.concatenate([n for _, n in levels])
    keys, first = np.unique(_keys(rows), return_index=True)
    if not len(keys):
        return keys, np.empty(0)
    rows, total = rows[first], counts[first]
    context = rows.copy()
    context[:, -1] = 0
    context_key = _keys(context)
    ctx, mass, types = _sums(context_key, total, np.ones(len(total)))
    at = np.searchsorted(ctx, context_key)
    own = np.maximum(total - DISCOUNT, 0) / mass[at]
    spare = DISCOUNT * types[at] / mass[at]
    used = (rows > 0).sum(1)
    uniform = 1.0 / (np.count_nonzero(used == 1) + 1)
    lower = rows.copy()
    lower[np.arange(len(rows)), rows.shape[1] - used] = 0
    lower_key = _keys(lower)
    p = np.zeros(len(keys))
    for n in range(1, rows.shape[1] + 1):
        here = used == n
        below = uniform if n == 1 else _lookup(keys, p, lower_key[here], uniform)
        p[here] = own[here] + spare[here] * below
    return keys, p


def fit_model(grams: list[str], toxic: np.ndarray, ordinary: np.ndarray) -> Model:
    """The ratios of the two class models over counted character sequences."""
    seen = (toxic > 0) | (ordinary > 0)
    if not (toxic > 0).any() or not (ordinary > 0).any():
        return Model()
    toxic, ordinary = toxic[seen].astype(float), ordinary[seen].astype(float)
    padded = "".join(g.rjust(ORDER, "\0") for g, s in zip(grams, seen) if s)
    chars = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
    shared_keys, shared_p = _shared(chars)
    used = (chars > 0).sum(1)
    suffix = chars.copy()
    suffix[np.arange(len(chars)), ORDER - used] = 0
    back = _lookup(shared_keys, shared_p, _keys(suffix), 1e-9)
    # a context keeps its place: its last character moves to the end
    context = np.roll(chars, 1, axis=1)
    context[:, 0] = 0
    context_key = _keys(context)
    ctx, t_mass, o_mass, t_types, o_types = _sums(
        context_key, toxic, ordinary, (toxic > 0).astype(float), (ordinary > 0).astype(float)
    )

    def spare(types, mass):
        return np.where(mass > 0, DISCOUNT * types / np.maximum(mass, 1), 1.0)

    t_spare, o_spare = spare(t_types, t_mass), spare(o_types, o_mass)
    at = np.searchsorted(ctx, context_key)

    def p(count, mass, spare_):
        return np.maximum(count - DISCOUNT, 0) / np.maximum(mass[at], 1) + spare_[at] * back

    ratio = np.log(p(toxic, t_mass, t_spare) / p(ordinary, o_mass, o_spare))
    keys = _keys(chars)
    order = np.argsort(keys)
    return Model(keys[order], ratio[order].astype(np.float32), ctx,
                 np.log(t_spare / o_spare).astype(np.float32))


def _keyed(df: DataFrame) -> DataFrame:
    """(key, value) of rows (sequence, value)."""

    def run(batches_in):
        for batch in batches_in:
            padded = "".join(g.rjust(ORDER, "\0") for g in batch.column(0).to_pylist())
            chars = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_keys(chars).view(np.int64)), batch.column(1)], names=["key", "value"]
            )

    return df.mapInArrow(run, "key bigint, value float")


def fit_tables(counted: DataFrame, toxic: str, ordinary: str) -> Model | Tables:
    """``fit_model`` over the counts of two columns, by joins instead of on the driver."""
    counted = counted.select("gram", F.col(toxic).alias("t"), F.col(ordinary).alias("o")).where("t > 0 OR o > 0")
    if any(not n for n in counted.agg(F.sum("t"), F.sum("o")).first()):
        return Model()
    oldest_off, context = F.expr("substring(gram, 2)"), F.expr("substring(gram, 1, char_length(gram) - 1)")
    # the kinds of n characters: those counted, and what the longer kinds end in
    follow = {}
    for n in range(ORDER, 1, -1):
        layer = counted.where(F.char_length("gram") == n).select("gram")
        if n < ORDER:
            layer = layer.union(follow[n].select("gram")).distinct()
        follow[n - 1] = held(layer.groupBy(oldest_off.alias("gram")).agg(F.count(F.lit(1)).alias("total")))
    uniform = F.lit(1.0 / (follow[1].count() + 1))
    level = shared = None
    for n in range(1, ORDER):
        rows = follow[n].withColumn("context", context)
        mass = rows.groupBy("context").agg(F.sum("total").alias("mass"), F.count(F.lit(1)).alias("types"))
        rows = rows.join(mass, "context").withColumn("lower", oldest_off)
        if n == 1:
            rows = rows.withColumn("below", uniform)
        else:
            rows = rows.join(level.select(F.col("gram").alias("lower"), F.col("p").alias("below")), "lower")
        own = F.greatest(F.col("total") - DISCOUNT, F.lit(0.0)) / F.col("mass")
        level = held(rows.select("gram", (own + DISCOUNT * F.col("types") / F.col("mass") * F.col("below")).alias("p")))
        shared = level if shared is None else shared.union(level)

    def spare(z):
        return F.when(F.col(f"{z}_mass") > 0, DISCOUNT * F.col(f"{z}_types") / F.col(f"{z}_mass")).otherwise(1.0)

    contexts = held(
        counted.groupBy(context.alias("context"))
        .agg(*[F.sum(z).alias(f"{z}_mass") for z in "to"], *[F.count_if(F.col(z) > 0).alias(f"{z}_types") for z in "to"])
        .withColumn("t_spare", spare("t")).withColumn("o_spare", spare("o"))
    )

    def p(z):
        own = F.greatest(F.col(z) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"{z}_mass"), F.lit(1))
        return own + F.col(f"{z}_spare") * F.col("back")

    graded = (
        counted.withColumn("context", context).withColumn("lower", oldest_off).join(contexts, "context")
        .join(shared.select(F.col("gram").alias("lower"), F.col("p").alias("back")), "lower")
    )
    return Tables(
        held(_keyed(graded.select("gram", F.log(p("t") / p("o")).cast("float").alias("value")))),
        held(_keyed(contexts.select("context", F.log(F.col("t_spare") / F.col("o_spare")).cast("float").alias("value")))),
    )


def count_grams(labelled: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary, fit_toxic, fit_ordinary) over rows (text, toxic, fit)."""

    def run(batches_in):
        def flush(words):
            counts: dict[str, list[int]] = {}
            for kind, counter in words.items():
                for word, n in counter.items():
                    s = START + normal(word) + END
                    for i in range(1, len(s)):
                        counts.setdefault(s[max(0, i - ORDER + 1) : i + 1], [0, 0, 0, 0])[kind] += n
            grams = list(counts)
            for a in range(0, len(grams), 50_000):
                part = grams[a : a + 50_000]
                values = np.array([counts[g] for g in part], np.int64)
                # kind = 2 * (not seen by the fit models) + ordinary
                both = (values[:, 0] + values[:, 2], values[:, 1] + values[:, 3], values[:, 0], values[:, 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), *(pa.array(v) for v in both)],
                    names=["gram", "toxic", "ordinary", "fit_toxic", "fit_ordinary"],
                )

        words = {k: Counter() for k in range(4)}
        for batch in batches_in:
            for raw, toxic, fit in zip(utf8(batch.column(0)), batch.column(1).to_pylist(),
                                       batch.column(2).to_pylist()):
                words[2 * (not fit) + (not toxic)].update((raw or b"").lower().split())
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield from flush(words)
                    words = {k: Counter() for k in range(4)}
        yield from flush(words)

    schema = "gram string, toxic bigint, ordinary bigint, fit_toxic bigint, fit_ordinary bigint"
    sums = [F.sum(c).alias(c) for c in ("toxic", "ordinary", "fit_toxic", "fit_ordinary")]
    return labelled.select("text", "toxic", "fit").mapInArrow(run, schema).groupBy("gram").agg(*sums)


def _cutoff(counted: DataFrame) -> int:
    """The lowest count that leaves at most ``MODEL_GRAMS`` sequences."""
    n = F.least(F.col("toxic") + F.col("ordinary"), F.lit(1 << 20))
    # bins: exact up to 1024, then by powers of two, so the driver sees a bounded list
    low = F.when(n <= 1024, n).otherwise(F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))).cast("long"))
    bins = sorted((r[0], r[1]) for r in counted.groupBy(low.alias("n")).count().collect())
    left = sum(c for _, c in bins)
    for n, count in bins:
        if left <= MODEL_GRAMS:
            return n
        left -= count
    return (bins[-1][0] + 1) if bins else 1


@dataclass
class Scorer:
    """Both models (final and fit) and the logistic weights (bias, mean, peak)."""

    final: Model | Tables
    fit: Model | Tables
    weights: tuple[float, float, float] | None = None


def learn(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Count, build and calibrate from the rows whose id is not held out."""
    labels = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 2))
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    )
    # a merge join at every size: labels grow with the documents, so no broadcast
    train = docs.select("doc_id", "text").join(labels.hint("merge"), "doc_id")
    counted = held(count_grams(train.select("text", "toxic", (fold(F.col("doc_id")) != 3).alias("fit"))))
    if _cutoff(counted) > 1:  # the sequences do not all fit a driver
        scorer = Scorer(fit_tables(counted, "toxic", "ordinary"), fit_tables(counted, "fit_toxic", "fit_ordinary"))
    else:
        all_ = counted.toArrow()  # at most MODEL_GRAMS sequences
        grams = all_.column("gram").to_pylist()
        count = {c: all_.column(c).to_numpy() for c in all_.column_names[1:]}
        scorer = Scorer(
            fit_model(grams, count["toxic"], count["ordinary"]),
            fit_model(grams, count["fit_toxic"], count["fit_ordinary"]),
        )
    unseen = docs.select("doc_id", "text").where(fold(F.col("doc_id")) == 3)
    evidence = _evidence(unseen, scorer.fit, "evidence", drop=["text"])
    sample = (
        evidence.join(labels, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
        .select("evidence.mean", "evidence.peak", "toxic").toArrow()
    )
    x = np.column_stack([sample.column("mean").to_numpy(), sample.column("peak").to_numpy()])
    y = np.asarray(sample.column("toxic").to_pylist(), float)
    scorer.weights = logistic(x, y)
    return scorer


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float] | None:
    """Weights (bias, mean, peak) by Newton steps with a small ridge; None without both labels."""
    if not len(y) or y.min() == y.max():
        return None
    scale = x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(3)
    penalty = np.diag([1e-6, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1] / scale[0]), float(w[2] / scale[1])


def _measure(value: np.ndarray) -> tuple[float, float]:
    """Mean value of the words of a text, and of its highest passage."""
    run = min(PASSAGE, len(value))
    total = np.concatenate(([0.0], np.cumsum(value)))
    return value.mean(), (total[run:] - total[:-run]).max() / run


def _evidence(df: DataFrame, model: Model | Tables, name: str, drop: list[str]) -> DataFrame:
    """``df`` without ``drop`` and with a struct column ``name`` of (mean, peak)."""
    if isinstance(model, Tables):
        return _joined_evidence(df, model, name, drop)
    known = df.sparkSession.sparkContext.broadcast(model)  # at most MODEL_GRAMS sequences
    at = df.columns.index("text")
    kept = [i for i, c in enumerate(df.columns) if c not in drop]
    schema = T.StructType([df.schema[i] for i in kept] + [
        T.StructField(name, T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("peak", T.DoubleType())]))
    ])

    def run(batches_in):
        memo: dict[bytes, float] = {}
        for batch in batches_in:
            mean, peak = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, raw in enumerate(utf8(batch.column(at))):
                words = (raw or b"").lower().split()
                if not words:
                    continue
                new = list(set(words).difference(memo))
                if len(memo) + len(new) > HELD_WORDS:
                    memo.clear()
                    new = list(set(words))
                memo.update(zip(new, known.value.words([normal(w) for w in new]).tolist()))
                value = np.fromiter(map(memo.__getitem__, words), float, len(words))
                mean[i], peak[i] = _measure(value)
            found = pa.StructArray.from_arrays([pa.array(mean), pa.array(peak)], names=["mean", "peak"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(j) for j in kept] + [found], names=[batch.schema.names[j] for j in kept] + [name]
            )

    return df.mapInArrow(run, schema)


def _joined_evidence(df: DataFrame, model: Tables, name: str, drop: list[str]) -> DataFrame:
    """``_evidence`` by joins: a block's sequences meet the tables, and their values its texts."""
    kept = [c for c in df.columns if c not in drop]
    schema = T.StructType([df.schema[c] for c in kept] + [
        T.StructField(name, T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("peak", T.DoubleType())]))
    ])
    chars = df.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = F.lit(chars // BLOCK_CHARS + 1)
    # both uses read all columns, so that the texts are dealt out once
    placed = df.withColumn("__block", F.pmod(F.xxhash64("doc_id", "text"), blocks))
    at, own = df.columns.index("text"), len(df.columns)

    def sequences(table: pa.Table) -> pa.Table:
        seen = set()
        for raw in utf8(table.column(at)):
            seen.update((raw or b"").lower().split())
        if not seen:
            return pa.table({"__block": pa.array([], pa.int64()), "key": pa.array([], pa.int64()),
                             "context": pa.array([], pa.int64())})
        _, _, inside, context, gram = _places([normal(w) for w in seen])
        gram, first = np.unique(gram[inside > 0], return_index=True)
        context = context[inside > 0][first]
        block = np.full(len(gram), table.column(own)[0].as_py(), np.int64)
        return pa.table({"__block": block, "key": gram.view(np.int64), "context": context.view(np.int64)})

    wanted = placed.groupBy("__block").applyInArrow(sequences, "__block bigint, key bigint, context bigint")
    backoffs = model.contexts.select(F.col("key").alias("context"), F.col("value").alias("backoff"))
    values = (
        wanted.join(model.grams, "key", "left").join(backoffs, "context", "left")
        .select("__block", "key", F.coalesce("value", "backoff", F.lit(0.0).cast("float")).alias("value"))
    )

    def measure(texts: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column(1).to_numpy().view(np.uint64)
        order = np.argsort(keys)
        block = Model(keys[order], known.column(2).to_numpy()[order])
        lines = [(raw or b"").lower().split() for raw in utf8(texts.column(at))]
        words = list(set().union(*lines))
        value = dict(zip(words, block.words([normal(w) for w in words]).tolist()))
        found = [_measure(np.fromiter(map(value.__getitem__, x), float, len(x))) if x else (0.0, 0.0) for x in lines]
        evidence = pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64())],
            names=["mean", "peak"],
        )
        return pa.table([*(texts.column(c) for c in kept), evidence], names=[*kept, name])

    return placed.groupBy("__block").cogroup(values.groupBy("__block")).applyInArrow(measure, schema)


def _score(scorer: Scorer, evidence: Column) -> Column:
    if scorer.weights is None:
        return F.lit(0.0)
    bias, mean, peak = scorer.weights
    z = F.lit(bias) + F.lit(mean) * evidence["mean"] + F.lit(peak) * evidence["peak"]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    found = _evidence(docs.select("doc_id", "text"), scorer.final, "evidence", drop=["text"])
    value = _score(scorer, F.col("evidence"))
    return found.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        value.alias("score"),
        (value >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    found = _evidence(docs, scorer.final, "__evidence", drop=[])
    return found.where(_score(scorer, F.col("__evidence")) < THRESHOLD).drop("__evidence")
