import random
import re
from itertools import permutations

import pytest

from tests.conftest import SF_SMALL
from tests.llm.brute import CLASHING, DOCS, odd_docs
from tripmart.llm import filteraudit

LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """Every document under every order."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    smallest = {}
    for i, text, *_ in docs:
        if i is not None:
            smallest[text or ""] = min(smallest.get(text or "", i), i)
    fails = []
    for i, text, lang, *_ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        f |= {"A"} if len(words) < 200 else set()
        f |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search("[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and i > smallest[t] else set()
        fails.append((lang or "", f, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [x[1:] for x in fails if x[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                removed_by[letter] += len(gone)
                rows.append(("".join(order), step, letter, len(left), len(gone), sum(letter in x[0] for x in own) - len(gone),
                             sum(x[0] == {letter} for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone)))
        for order, step, letter, *counts in rows:
            out[part, order, step] = (*counts, removed_by[letter])
    return out


def result(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_equals_every_order_by_itself(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(["a", "b", "Word", "UPPER", "x$", "tail|", f"w{rng.randrange(400)}"]) for _ in range(rng.choice([3, 150, 230, 260]))]
        docs.append((i, " ".join(words) if rng.random() > 0.2 or not docs else rng.choice(docs)[1], rng.choice(["de", "en", None, ""]), "s", 0))
        if rng.random() < 0.6:
            labels.append((i, rng.randrange(2), rng.randrange(2)))
    got = result(filteraudit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)))
    assert got == brute(docs, labels)


def test_odd_rows(spark):
    docs = odd_docs()
    docs += [(None, docs[0][1], *docs[0][2:]), (1, docs[0][1], *docs[0][2:]), (500, "", *docs[0][2:]), (501, None, None, None, None),
             (502, "$" + "Z" * 100_000, "de", "s", 1)]
    labels = [(1, 1, None), (1, 0, 1), (None, 1, 1), (2, None, None), (500, 1, 1), (9_999, 1, 1)]
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    for c in (*CLASHING, "part", "mask", "same", "own", "good", "toxic", "n", "rank"):
        df = df.withColumn(c, df.source)
        if c not in marks.columns:
            marks = marks.withColumn(c, marks.doc_id)
    want = brute(docs, labels)
    assert result(filteraudit.audit(df, marks)) == want
    assert result(filteraudit.audit(df, marks.limit(0))).keys() == want.keys()
    assert filteraudit.audit(df.limit(0), marks).count() == 0


def test_intervals_cover_what_a_mask_fails():
    found = filteraudit.intervals()
    assert len({(m, s, a) for m, s, a, _ in found}) == len(found)
    for mask in range(1, 32):
        covered = sorted(r for m, _, a, b in found if m == mask for r in range(a, b))
        assert covered == list(range(120))  # it goes once under every order


@pytest.mark.parametrize("table", [SF_SMALL])
def test_given_tables(spark, table):
    docs, labels = (spark.read.parquet(f"{table}/{t}.parquet") for t in ("documents", "labels"))
    got = result(filteraudit.audit(docs, labels))
    assert got == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()])
