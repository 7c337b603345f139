"""Landing outcomes per scenario (A6) and on the documents listing."""

from tests.conftest import SF_MID
from tripmart.operators import landing as L
from tripmart.sources import fixtures

LISTING = "key string, status int, etag string, declared_size bigint"
LEDGER = "key string, etag string, size bigint"


def test_outcomes_equal_the_rules_for_every_combination(spark):
    """Every status, marker, ledger entry, size and option, decided again in plain Python."""
    import itertools

    cases = list(itertools.product([200, 304, 403, 418, 503], ["m1", '"m2"', None], [None, "m1", "m2", ""], [7, None]))
    keys = [f"k{i}" for i in range(len(cases))]
    listing = spark.createDataFrame([(k, c[0], c[1], c[3]) for k, c in zip(keys, cases)], LISTING)
    ledger = spark.createDataFrame([(k, c[2], 7) for k, c in zip(keys, cases) if c[2] is not None], LEDGER)
    for forced, excused in itertools.product([False, True], [(), (403,), (403, 418)]):
        got = {r.key: r.resultado for r in L.classify(listing, ledger, forced, excused).collect()}
        for key, (status, etag, recorded, size) in zip(keys, cases):
            marker = (etag or "").strip('"')
            if status in excused:
                want = L.NOT_AVAILABLE
            elif status >= 400 or size is None:
                want = L.ERROR
            elif recorded is None or forced:
                want = L.DOWNLOADED
            else:
                want = L.ALREADY_PRESENT if recorded == marker else L.REVISION
            assert got[key] == want, (status, etag, recorded, size, forced, excused)


def test_incomplete_transfer_never_reaches_the_ledger(spark):
    listing = spark.createDataFrame([("k", 200, "abc", 1024)], LISTING)
    ledger = spark.createDataFrame([], LEDGER + ", landed_at timestamp_ntz")
    landed = spark.createDataFrame([("k", 500)], "key string, length bigint")
    v = L.verify_sizes(L.classify(listing, ledger), landed)
    assert v.first()["completo"] is False
    assert L.next_ledger(ledger, v).count() == 0


def test_b3_counts(spark):
    c = L.classify(fixtures.listing(spark, SF_MID), fixtures.ledger(spark, SF_MID), excused=L.TRIPS_NOT_PUBLISHED)
    counts = {r.resultado: r.n for r in L.outcome_counts(c).collect()}
    assert counts == {"descargado": 314, "no_disponible": 59, "revision": 125, "ya_presente": 502}
    v = L.verify_sizes(c, fixtures.landed_objects(spark, SF_MID))
    new = L.next_ledger(fixtures.ledger(spark, SF_MID), v)
    accepted = v.where("completo").count()
    # ledger keeps its keys, replaces revised ones, adds new ones; the source marker is stored
    assert new.count() == new.select("key").distinct().count()
    assert new.join(v.where("completo").select("key", "etag"), ["key", "etag"], "left_semi").count() == accepted


def test_pending_months_stop_at_the_first_unpublished(spark):
    published = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-03",), ("2024-05",)], "mes string")
    landed = spark.createDataFrame([("2024-01",)], "mes string")
    got = sorted(r.mes for r in L.pending_months(published, landed, months_past_last=2).collect())
    assert got == ["2024-02", "2024-03"]


def test_landed_files_listing(spark, tmp_path):
    from tripmart.sources.landed import landed_files

    root = tmp_path / "landing.v1"
    (root / "tlc").mkdir(parents=True)
    (root / "tlc" / "a.bin").write_bytes(b"x" * 1024)
    (root / "tlc" / "b.bin").write_bytes(b"y" * 500)
    got = {r.key: r.length for r in landed_files(spark, f"file://{root}").collect()}
    assert got == {"tlc/a.bin": 1024, "tlc/b.bin": 500}
    listing = spark.createDataFrame([("tlc/a.bin", 200, "e1", 1024), ("tlc/b.bin", 200, "e2", 1024)], LISTING)
    ledger = spark.createDataFrame([], LEDGER)
    v = L.verify_sizes(L.classify(listing, ledger), landed_files(spark, f"file://{root}"))
    assert {r.key: r.completo for r in v.collect()} == {"tlc/a.bin": True, "tlc/b.bin": False}


def test_quoted_and_absent_markers(spark):
    listing = spark.createDataFrame([("a", 200, '"abc"', 1), ("b", 200, None, 1)], LISTING)
    ledger = spark.createDataFrame([("a", "abc", 1), ("b", "", 1)], LEDGER)
    got = {r.key: (r.etag, r.resultado) for r in L.classify(listing, ledger).collect()}
    assert got == {"a": ("abc", L.ALREADY_PRESENT), "b": ("", L.ALREADY_PRESENT)}
