"""The pipeline's stages against plain versions, each on its own input."""

import hashlib

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.brute import line_dedup, mix
from tests.llm.test_minhash import plain_kept
from tests.llm.test_tokens import expected
from tripmart.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tuples(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = before, docs
        if name != "byte_bpe":
            assert docs.columns == COLUMNS

    before, after = kept["toxicity"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = toxicity.score(before, toxicity.learn(before, labels)).collect()
    assert sorted(r.doc_id for r in scores if not r.predicted) == sorted(r[0] for r in tuples(after))
    # labels carry some noise: nearly all toxic words are gone, nearly all clean documents stay
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(clean & {r[0] for r in tuples(after)}) >= 0.9 * len(clean)

    before, after = kept["line_dedup"]
    rows = tuples(before)
    old = {r[0]: r[1] for r in rows}
    want = {i: t for i, t in line_dedup(rows) if t == old[i] or t.split()}
    assert {r[0]: r[1] for r in tuples(after)} == want
    assert all(r[4] == len(r[1]) for r in tuples(after))

    before, after = kept["near_dedup"]
    assert sorted(r[0] for r in tuples(after)) == plain_kept(tuples(before), 5, 80)

    before, after = kept["mixing"]
    texts = {r[0]: r for r in tuples(before)}
    count = {}
    for r in tuples(after):
        assert r == texts[r[0]]
        count[r[0]] = count.get(r[0], 0) + 1
    assert all(count.get(i, 0) * n == taken for i, n, _, _, taken in mix(tuples(before)))

    before, after = kept["byte_bpe"]
    assert sorted(map(tuple, after.collect())) == sorted((r[0], *expected(r[1])) for r in tuples(before))


def test_run_equals_the_stages_and_reruns_agree(spark):
    def digest():
        rows = sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect()))
        return hashlib.sha256(repr(rows).encode()).hexdigest(), len(rows)

    assert digest() == digest()
