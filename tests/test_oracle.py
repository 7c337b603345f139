"""Every registered query against its DuckDB oracle, at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import digest, duck
from tripmart.plans import catalog, oracle

ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(E.oracle_sql()) and set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 3887


def test_contract_report_finds_every_variant(spark):
    rows = E.queries()["contract_report"](spark, SF_SMALL).collect()
    assert {r.ausentes for r in rows} == {"", "RatecodeID,tolls_amount"} and {r.sobrantes for r in rows} == {"", "peaje_puente"}
    assert any(r.perdidas for r in rows) and all((r.perdidas is None) == (not r.contrato_ok) for r in rows)


@pytest.mark.parametrize("partitions,bits", [("1", 16), ("8", 8), ("64", 32)])
def test_speed_ranks_do_not_depend_on_partitions_or_digits(spark, con, monkeypatch, partitions, bits):
    from tripmart.operators import profile

    monkeypatch.setattr(profile, "DIGIT_BITS", bits)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        test_query_matches_oracle(spark, con, "speed_profile_one_month")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
