import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import frame, odd_docs, sentence
from tripmart.llm import toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def planted(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.choice([3, 30, 200])).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(1 + len(words) // 60):
                bad = rng.choice(["vermin", "scumbag"]) + rng.choice(["", "s", "ly", "ish", "ette", "oid"])
                words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    return rows, labels


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def test_held_out_documents_are_told_apart(spark):
    rows, labels = planted()
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    got = toxicity.score(docs, toxicity.learn(docs, marks)).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (fold(r.doc_id) == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.97 * len(held)


def test_held_out_labels_are_not_read(spark):
    rows, labels = planted(200)
    docs = frame(spark, rows)
    flipped = [(i, q, 1 - t if fold(i) == 2 else t) for i, q, t in labels]
    a, b = ({r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, spark.createDataFrame(x, LABELS))).collect()}
            for x in (labels, flipped))
    assert a == b


def plain_ratios(toxic, ordinary, order, d):
    """Word ratios by the textbook recursion over dictionaries."""
    grams = {1: Counter(), 0: Counter()}
    for z, words in ((1, toxic), (0, ordinary)):
        for w in words:
            s = "\x02" + w + "\x03"
            for i in range(1, len(s)):
                grams[z][s[max(0, i - order + 1) : i + 1]] += 1
    kinds = defaultdict(set)
    for g in [*grams[0], *grams[1]]:
        kinds[len(g)].add(g)
    follow = defaultdict(set)
    for n in range(order, 1, -1):
        for g in list(kinds[n]):
            follow[g[1:]].add(g[0])
            kinds[n - 1].add(g[1:])
    n_cont = {g: len(s) for g, s in follow.items()}
    ctx = defaultdict(list)
    for g, n in n_cont.items():
        ctx[g[:-1]].append(n)
    vocabulary = len(ctx[""]) + 1

    def shared(g):
        below = shared(g[1:]) if len(g) > 1 else 1 / vocabulary
        total = ctx.get(g[:-1])
        if not total:
            return below
        return max(n_cont.get(g, 0) - d, 0) / sum(total) + d * len(total) / sum(total) * below

    def p(z, g):
        own = [n for k, n in grams[z].items() if k[:-1] == g[:-1]]
        back = shared(g[1:])
        if not own:
            return back
        return max(grams[z][g] - d, 0) / sum(own) + d * len(own) / sum(own) * back

    def ratio(w):
        s = "\x02" + w + "\x03"
        return sum(math.log(p(1, s[max(0, i - order + 1) : i + 1]) / p(0, s[max(0, i - order + 1) : i + 1]))
                   for i in range(1, len(s)))

    return ratio


def test_model_equals_the_plain_recursion(spark):
    toxic = "bad badly worse worst nasty nast baddy".split() * 2 + ["bad"] * 5
    ordinary = "good goody nice well weather bath basket nest worsted".split() * 3
    rows = [(" ".join(toxic), True, True), (" ".join(ordinary), False, True)]
    counted = toxicity.count_grams(spark.createDataFrame(rows, "text string, toxic boolean, fit boolean")).toPandas()
    model = toxicity.fit_model(list(counted.gram), counted.toxic.to_numpy(), counted.ordinary.to_numpy())
    plain = plain_ratios(toxic, ordinary, toxicity.ORDER, toxicity.DISCOUNT)
    words = ["bad", "badly", "good", "worst", "worsted", "unseen", "b", "", "baskets"]
    assert model.words(words) == pytest.approx([plain(w) for w in words], abs=1e-4)


def test_odd_rows_and_missing_labels(spark):
    rows, labels = planted(200)
    odd = odd_docs()
    docs = frame(spark, rows + [(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in odd])
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (10_001, 0, 0), (10_001, 0, 0), (77_777, 1, 1)], LABELS)
    scorer = toxicity.learn(docs, marks)
    got = toxicity.score(docs, scorer).collect()
    assert len(got) == len(rows) + len(odd)
    empty = [r.score for r in got if r.doc_id in (10_002, 10_003, 10_004)]
    assert len(set(empty)) == 1 and empty[0] < 0.3
    assert all(r.held_out is False for r in got if r.doc_id is None)
    left = toxicity.keep_clean(docs, scorer)
    assert left.columns == docs.columns
    assert left.count() == sum(r.predicted == 0 for r in got)
    for none in (marks.limit(0), marks.where("toxic = 0")):
        assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), marks)).count() == 0


def test_rare_sequences_go_first_when_the_model_is_full(spark, monkeypatch):
    rows, labels = planted(100)
    docs = frame(spark, rows)
    train = docs.join(spark.createDataFrame(labels, LABELS).select("doc_id", F.col("toxic") > 0), "doc_id").toDF(
        *docs.columns, "toxic").select("text", "toxic", F.lit(True).alias("fit"))
    counted = toxicity.count_grams(train).cache()
    totals = np.array([r[0] for r in counted.select(F.col("toxic") + F.col("ordinary")).collect()])
    for most in (len(totals), len(totals) // 2, 10, 0):
        monkeypatch.setattr(toxicity, "MODEL_GRAMS", most)
        cut = toxicity._cutoff(counted)
        assert (totals >= cut).sum() <= most
        assert cut <= 1 or most < (totals >= 1).sum()


def test_tables_give_the_scores_of_the_whole_model(spark, monkeypatch):
    rows, labels = planted(200, seed=4)
    docs = frame(spark, rows + [(10_000 + i, *r[1:]) for i, r in enumerate(odd_docs())])
    marks = spark.createDataFrame(labels, LABELS)

    def scores():
        scorer = toxicity.learn(docs, marks)
        found = {r.doc_id: r.score for r in toxicity.score(docs, scorer).collect()}
        return found, sorted(r.doc_id for r in toxicity.keep_clean(docs, scorer).collect()), scorer

    whole, clean, _ = scores()
    # more sequences than a driver may hold: none may be left out
    monkeypatch.setattr(toxicity, "MODEL_GRAMS", 50)
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 20_000)
    tables, left, scorer = scores()
    assert whole.keys() == tables.keys() and clean == left
    assert [tables[k] for k in whole] == pytest.approx([whole[k] for k in whole], abs=1e-5)
    assert isinstance(scorer.final, toxicity.Tables)
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, marks.where("toxic = 0"))).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), scorer).count() == 0
