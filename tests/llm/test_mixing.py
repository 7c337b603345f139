import random

from tests.llm.brute import frame, mix, odd_docs, sentence
from tripmart.llm import mixing


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def generated():
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        s = rng.choice([*"abcdefg", None, "é", "Z"])
        rows.append((i, sentence(rng, rng.randrange(0, 30) if s != "c" else 2), "en", s, 0))
    return rows


def test_equals_the_plain_mix(spark):
    rows = generated()
    df = frame(spark, rows)
    first = rows_of(mixing.plan(df))
    assert first == sorted(mix(rows), key=str)
    assert rows_of(mixing.plan(df.repartition(5))) == first


def test_targets_are_met_and_capped(spark):
    rows = generated()
    found = mixing.plan(frame(spark, rows)).collect()
    taken, target = {}, {}
    for r in found:
        assert r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.target <= 2 * r.source_size
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.15 * t
    assert abs(sum(target.values()) - 1.5 * sum(r.size for r in found)) < 1e-6


def test_emit_repeats_the_rows(spark):
    rows = generated()
    df = frame(spark, rows)
    out = mixing.emit(df)
    assert out.columns == df.columns
    count = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    for doc_id, size, _, _, taken in mix(rows):
        if size:
            assert count.get(doc_id, 0) == taken // size


def test_odd_rows(spark):
    rows = odd_docs()
    assert rows_of(mixing.plan(frame(spark, rows))) == sorted(mix(rows), key=str)


def test_empty_table_and_no_words(spark):
    assert mixing.plan(frame(spark, [])).count() == 0
    assert mixing.emit(frame(spark, [])).count() == 0
    rows = [(1, None, "en", None, 0), (2, "", "en", "a", 0)]
    assert rows_of(mixing.plan(frame(spark, rows))) == sorted(mix(rows), key=str)
