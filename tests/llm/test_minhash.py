import random

from tests.llm.brute import frame, near_components, odd_docs, sentence, shingle_set
from tripmart.llm import minhash
from tripmart.llm.components import components


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def generated(seed=3, bases=8, copies=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = sentence(rng, rng.choice([8, 40, 90, 200])).split()
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = rng.choice(["alpha", "beta", "gamma"])
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(rows)]


def test_equals_all_pairs(spark):
    rows = generated()
    assert rows_of(minhash.near_duplicates(frame(spark, rows))) == sorted(near_components(rows), key=str)


def test_small_blocks_give_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", 150)
    rows = generated(seed=4)
    assert rows_of(minhash.near_duplicates(frame(spark, rows))) == sorted(near_components(rows), key=str)


def test_odd_rows(spark):
    rows = odd_docs()
    assert rows_of(minhash.near_duplicates(frame(spark, rows))) == sorted(near_components(rows), key=str)


def test_keep_first_keeps_columns_and_one_of_each_group(spark):
    rows = odd_docs()
    df = frame(spark, rows)
    left = minhash.keep_first(df)
    assert left.columns == df.columns
    ids = sorted((r.doc_id for r in left.collect()), key=str)
    heads = {r[0] for r in near_components(rows) if r[3]}
    assert [i for i in ids if i is not None] == sorted((i for i in heads if i is not None), key=str)
    assert ids.count(None) == 2


def test_empty_table(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    assert minhash.keep_first(frame(spark, [])).count() == 0


def test_a_shared_list_ties_every_pair_of_enough_coordinates():
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 32, minhash.COORDINATES, dtype=np.uint32)
    sigs = []
    for _ in range(60):
        s = base.copy()
        n = rng.integers(0, minhash.COORDINATES)
        s[rng.choice(minhash.COORDINATES, n, replace=False)] = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        sigs.append(s)
    sigs = np.array(sigs)
    edges, _ = minhash._tie(list(range(60)), sigs)
    group = list(range(60))
    for a, b in edges:
        x, y = group[a], group[b]
        group = [y if g == x else g for g in group]
    for i in range(60):
        for j in range(i):
            if (sigs[i] == sigs[j]).sum() >= minhash.MATCHES:
                assert group[i] == group[j]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_kept(rows, width, percent):
    """Ids that stay, by testing every pair."""
    sets = [shingle_set(r[1], width) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group = [group[j] if g == group[i] else g for g in group]
    return sorted(min(r[0] for r, h in zip(rows, group) if h == g) for g in set(group))


def test_the_pipeline_stage_takes_five_words_and_four_fifths(spark):
    import corpus_pipeline

    rng = random.Random(9)
    base = sentence(rng, 200).split()
    passage = base[:90] + sentence(rng, 16).split() + base[106:]
    texts = [" ".join(base), " ".join(base) + " " + sentence(rng, 40), " ".join(passage)]
    rows = generated(seed=5) + [(1000 + i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = frame(spark, rows)
    stage = corpus_pipeline.stage_near_dedup(spark, docs, "")
    got = sorted(r.doc_id for r in stage.collect())
    assert got == plain_kept(rows, 5, 80)
    assert 1000 in got and not {1001, 1002} & set(got)


def test_matches_follow_the_threshold():
    assert minhash.matches_for(minhash.PERCENT) == minhash.MATCHES
    assert minhash.matches_for(80) == 22


def test_partners_of_different_blocks_meet_through_their_leaders(spark, monkeypatch):
    import numpy as np
    import xxhash

    def block(node, n):
        value = xxhash.xxh64_intdigest(node, seed=42)
        return (value - (value >> 63 << 64)) % n

    def changed(sig, places, by):
        out = sig.copy()
        out[list(places)] += by
        return out

    # x and y share 26 coordinates; every list they share holds a leader of x and one of y,
    # which share 40 with them, and 10 to 14 with each other
    x = np.arange(48, dtype=np.uint32) + 1000
    y = changed(x, range(26, 48), 10_000)
    of_x = [changed(x, range(0, 8), 20_000), changed(x, range(8, 16), 30_000)]
    of_y = [changed(y, range(16, 24), 40_000), changed(y, range(4, 12), 50_000)]
    assert (x == y).sum() == 26 and all((a == x).sum() == 40 for a in of_x) and all((b == y).sum() == 40 for b in of_y)
    assert sorted((a == b).sum() for a in of_x for b in of_y) == [10, 10, 14, 14]
    # others make the coordinates that x and y do not share more common than those they share
    others = [changed(s, range(26), 100_000 * (i + 1)) for i, s in enumerate([x] * 4 + [y] * 4)]
    monkeypatch.setattr(minhash, "BLOCK", 3)
    # a leader comes first in its block: x's in block 0, y's in block 1 of each list they share
    names = {0: [], 1: []}
    for i in range(40):
        name = i.to_bytes(16, "big")
        names[block(name, 2)].append(name)
    n1, n2 = names[0][2], names[1][2]
    rows = list(zip(names[0][:3] + names[1][:3], [*of_x, x, *of_y, y]))
    rows += [((1000 + i).to_bytes(16, "big"), s) for i, s in enumerate(others)]
    nodes = spark.createDataFrame([(bytearray(n), bytearray(s.tobytes())) for n, s in rows], "node binary, sig binary")
    group = {n: n for n, _ in rows}
    for r in minhash.candidates(nodes).collect():
        a, b = group[bytes(r.a)], group[bytes(r.b)]
        group = {k: b if g == a else g for k, g in group.items()}
    assert group[n1] == group[n2]


def test_long_texts_are_sketched_in_small_parts():
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefghij") + str(rng.randrange(10**6)) for _ in range(20_000)).encode()) for i in range(12)]
    rows += [(100 + i, b"a few words") for i in range(600)]
    parts = list(minhash._parts(iter(rows), minhash._Words(), minhash.WIDTH))
    assert [i for part in parts for i, _ in part] == [i for i, _ in rows]
    assert max(sum(len(s) for _, s in part) for part in parts) < minhash.SKETCH_SHINGLES + 20_000
    assert max(map(len, parts)) <= minhash.SKETCH_SETS


def test_the_query_bounds_the_batches_of_its_workers(spark):
    from tripmart.llm import common, queries

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        queries.op4_minhash_inverted(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key) == common.BATCH_BYTES
    finally:
        spark.conf.set(key, before)
