import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import edit_distance, frame, line_dedup, odd_docs, sentence
from tripmart.llm import linededup

text = st.text(alphabet="abc", max_size=30)


@settings(max_examples=400, deadline=None)
@given(text, text, st.integers(1, 4))
def test_banded_distance(a, b, k):
    assert linededup.within(a, b, k) == (edit_distance(a, b) <= k)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcd", min_size=8, max_size=60), st.data())
def test_linked_lines_meet_under_a_key(a, data):
    b = list(a)
    for _ in range(data.draw(st.integers(0, 2))):
        at, kind = data.draw(st.integers(0, len(b))), data.draw(st.integers(0, 2))
        if kind == 0:
            b.insert(at, "z")
        elif at < len(b):
            if kind == 1:
                del b[at]
            else:
                b[at] = "z"
    short, long = sorted((a, "".join(b)), key=len)
    own = {(n, i, short[s : s + z]) for n, i, s, z, mine in linededup.probes(len(short)) if mine}
    assert own & {(n, i, long[s : s + z]) for n, i, s, z, _ in linededup.probes(len(long))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdé", min_size=6, max_size=40), min_size=1, max_size=12, unique=True), st.integers(1, 3))
def test_postings_are_those_of_the_probes(lines, edits):
    keys, owners = linededup._postings(lines, np.arange(len(lines)), edits)
    want: dict[tuple, set] = {}
    for i, line in enumerate(lines):
        for n, part, start, size, mine in linededup.probes(len(line), edits):
            want.setdefault((n, part, line[start : start + size]), set()).add((i, mine))
    got: dict[int, set] = {}
    for k, o in zip(keys.tolist(), owners.tolist()):
        got.setdefault(k >> 1, set()).add((o, bool(k & 1)))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert all(linededup.node(linededup.name(x)) == linededup.node_of(x) for x in lines)


def generated(seed=1):
    rng = random.Random(seed)
    pool = [sentence(rng, rng.choice([3, 5, 12, 40])) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                at = rng.randrange(len(line))
                line[at] = rng.choice(["", "q", line[at] + "w"])
            lines.append("".join(line))
        rows.append((i, "\n".join(lines), "en", "s", 0))
    return rows


def got(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_equals_all_pairs(spark):
    rows = generated()
    out = linededup.dedup_lines(frame(spark, rows))
    assert got(out) == sorted(line_dedup(rows), key=str)
    for r in out.collect():
        left = len(r.text.split("\n")) if r.text else 0
        assert r.n_lines - r.n_exact - r.n_near in (left, left - 1, left + 1)


def test_small_blocks_and_parts_give_the_same_lines(spark, monkeypatch):
    monkeypatch.setattr(linededup, "GROUP_CHARS", 300)
    monkeypatch.setattr(linededup, "PART_POSTINGS", 50)
    rows = generated(seed=2)
    assert got(linededup.dedup_lines(frame(spark, rows))) == sorted(line_dedup(rows), key=str)


def test_odd_rows(spark):
    rows = odd_docs()
    df = frame(spark, rows)
    assert got(linededup.dedup_lines(df)) == sorted(line_dedup(rows), key=str)
    left = linededup.without_repeats(df)
    assert left.columns == df.columns
    # 5 and 15 repeat earlier lines only; empty and null texts lost nothing and stay
    kept = {r.doc_id for r in left.collect()}
    assert {1, 2, 3, 4, 6, 7, None} <= kept and not kept & {5, 15}


def test_empty_table(spark):
    assert linededup.dedup_lines(frame(spark, [])).count() == 0
    assert linededup.without_repeats(frame(spark, [])).count() == 0


def classes(pairs, n):
    head = list(range(n))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, j in pairs:
        head[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "record number ", "abab" * 9]), st.text(alphabet="ab1", max_size=16),
                          st.sampled_from(["", " was stored at node 7", "ba" * 9])), max_size=14, unique=True),
       st.integers(1, 3))
def test_links_of_a_group_are_those_of_all_pairs(parts, edits):
    lines = list(dict.fromkeys(map("".join, parts)))
    usual = linededup.FEW, linededup.MANY
    for many in (2, 4_000):
        linededup.FEW, linededup.MANY = 2, many
        try:
            got = linededup.link(lines, edits)
        finally:
            linededup.FEW, linededup.MANY = usual
        same_as_all_pairs(lines, got, edits)


def same_as_all_pairs(lines, got, edits):
    want = [(i, j) for i, x in enumerate(lines) for j, y in enumerate(lines[:i]) if edit_distance(x, y) <= edits]
    assert classes(got, len(lines)) == classes(want, len(lines))
    assert all(edit_distance(lines[i], lines[j]) <= edits for i, j in got)


def test_templated_lines_take_no_time_by_pairs():
    rng = random.Random(4)
    lines = list(dict.fromkeys(f"record {rng.randrange(10**9):09} was stored at node {rng.randrange(100)}" for _ in range(20_000)))
    begin = time.time()
    got = linededup.link(lines)
    assert time.time() - begin < 120
    some = rng.sample(range(len(lines)), 40)
    same = classes(got, len(lines))
    for i in some:
        for j, y in enumerate(lines):
            if linededup.within(lines[i], y, 2):
                assert same[i] == same[j]


def test_ties_within_batches_join_the_same_lines(spark, monkeypatch):
    rows = generated(seed=3)
    df = frame(spark, rows)
    whole = {frozenset(r) for r in linededup.ties(df, 100).collect()}
    monkeypatch.setattr(linededup, "BATCH_CHARS", 1)
    nodes = sorted({n for t in whole for n in t})
    at = {n: i for i, n in enumerate(nodes)}
    cut = {frozenset(r) for r in linededup.ties(df.repartition(7), 100).collect()}
    assert {n for t in cut for n in t} == set(nodes)
    edges = [classes([sorted(at[n] for n in t) for t in some], len(nodes)) for some in (whole, cut)]
    assert edges[0] == edges[1]


def test_short_lines_go_when_equal_only(spark):
    rows = [(1, "ok\n\nyes sir\n \n", "en", "s", 0), (2, "ok\nok!\n\t\n\n", "en", "s", 0), (3, "yes sir", "en", "s", 0)]
    df = frame(spark, rows)
    assert got(linededup.dedup_lines(df)) == [(1, "ok\n\nyes sir\n \n"), (2, "ok!\n\t\n\n"), (3, "")]
    assert {r.doc_id for r in linededup.without_repeats(df).collect()} == {1, 2}


def test_a_document_of_many_repeated_lines(spark):
    lines = [f"line {i}" for i in range(60_000)]
    rows = [(1, "\n".join(lines), "en", "s", 0), (2, "\n".join([*lines, "new"]), "en", "s", 0)]
    assert got(linededup.dedup_lines(frame(spark, rows))) == [(1, rows[0][1]), (2, "new")]


def test_near_copies_of_one_long_line():
    rng = random.Random(5)
    base = sentence(rng, 40).split()
    lines = set()
    while len(lines) < 2_500:
        words = list(base)
        for _ in range(rng.choice([1, 1, 2])):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        lines.add(" ".join(words))
    lines = sorted(lines)
    begin = time.time()
    got = linededup.link(lines)
    assert time.time() - begin < 30
    same = classes(got, len(lines))
    for i in rng.sample(range(len(lines)), 25):
        assert all(same[i] == same[j] for j, y in enumerate(lines) if linededup.within(lines[i], y, 2))
