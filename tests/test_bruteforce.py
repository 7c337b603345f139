"""Spark operators against brute force on small inputs, for random parameters."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tripmart.operators import landing as L
from tripmart.operators import serving
from tripmart.plans.catalog import mart_of

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def mart(spark):
    m = mart_of(spark, SF_SMALL)
    return m.cache(), m.toPandas()


@SETTINGS
@given(
    month=st.one_of(st.none(), st.sampled_from(["1995-03", "1998-07", "2001-11", "2030-01"])),
    zone=st.one_of(st.none(), st.integers(0, 28)),
    hour=st.one_of(st.none(), st.integers(0, 23)),
    limit=st.integers(0, 40),
)
def test_trips_equal_a_pandas_filter(mart, month, zone, hour, limit):
    df, pdf = mart
    flt = serving.TripFilter.parse(mes=month, zona=None if zone is None else str(zone),
                                   hora=None if hour is None else str(hour), limite=str(limit))
    got = [(r.mes, r.zona, r.hora, r.viajes, r.total) for r in serving.trips(df, flt).collect()]
    sel = pdf
    if month is not None:
        sel = sel[sel.mes == month]
    if zone is not None:
        sel = sel[sel.pu_location_id == zone]
    if hour is not None:
        sel = sel[sel.hora == hour]
    total = len(sel)
    sel = sel.sort_values(["mes", "pu_location_id", "hora"])
    if limit > 0:
        sel = sel.head(limit)
    want = [(r.mes, r.pu_location_id, r.hora, r.viajes, total) for r in sel.itertuples()]
    assert got == want


def reference_outcome(status, etag, size, recorded, forced, excused):
    """The landing rules restated in plain Python, in their order of precedence."""
    if status in excused:
        return L.NOT_AVAILABLE
    if status >= 400:
        return L.ERROR
    if size is None:
        return L.ERROR
    if recorded is not None and not forced:
        return L.ALREADY_PRESENT if recorded == etag else L.REVISION
    return L.DOWNLOADED


row = st.tuples(
    st.sampled_from([200, 200, 200, 304, 403, 404, 500]),
    st.sampled_from(["a", "b", "c"]),
    st.one_of(st.none(), st.integers(0, 10)),
    st.one_of(st.none(), st.sampled_from(["a", "b"])),
)


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=12), forced=st.booleans(),
       excused=st.sampled_from([(), (403, 404), (500,)]))
def test_classify_equals_the_rules(spark, rows, forced, excused):
    listing = spark.createDataFrame(
        [(f"k{i}", s, e, z) for i, (s, e, z, _) in enumerate(rows)],
        "key string, status int, etag string, declared_size bigint",
    )
    ledger = spark.createDataFrame(
        [(f"k{i}", r, 1) for i, (_, _, _, r) in enumerate(rows) if r is not None], "key string, etag string, size bigint"
    )
    got = {r.key: r.resultado for r in L.classify(listing, ledger, forced, excused).collect()}
    want = {f"k{i}": reference_outcome(s, e, z, r, forced, excused) for i, (s, e, z, r) in enumerate(rows)}
    assert got == want
