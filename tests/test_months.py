from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
import pytest

from tripmart.functions import months as M

month = st.builds(M.Month, st.integers(1, 9900), st.integers(1, 12))


@given(month)
def test_text_and_month_are_each_others_inverse(m):
    assert M.Month.of(str(m)) == m and M.month_text(str(m)) == str(m)


@given(month, st.integers(0, 40))
def test_ranges_step_through_the_calendar(m, n):
    last = m
    for _ in range(n):
        assert last < last.next() and (last.next().year * 12 + last.next().number) == last.year * 12 + last.number + 1
        last = last.next()
    got = M.month_range(str(m), str(last))
    assert len(got) == n + 1 and got == sorted(got) and (got[0], got[-1]) == (str(m), str(last))
    assert M.month_range(str(last.next()), str(m)) == []


@given(st.text(max_size=9))
def test_other_text_is_refused(text):
    try:
        M.Month.of(text)
    except M.BadMonth:
        return
    assert len(text) == 7 and text[4] == "-" and text.replace("-", "").isdigit() and 1 <= int(text[5:]) <= 12


@pytest.mark.parametrize("text", [None, 202403, "2031-6", "1987-21", "0199-0x", "２０２４-01", " 2020-05", "2020-05 "])
def test_near_misses_are_refused(text):
    with pytest.raises(M.BadMonth):
        M.month_text(text)


def test_paths_of_both_layouts(spark):
    folder, single = M.raw_folder("hdfs://x/lake/", "green", "2031-06"), M.raw_object("hdfs://x/lake", "green", "2031-06")
    assert folder == "hdfs://x/lake/raw/tlc/green/mes=2031-06"
    assert single == "hdfs://x/lake/raw/tlc/green/2031-06.parquet"
    with pytest.raises(M.BadService):
        M.raw_folder("x", "tram", "2031-06")
    paths = [f"{folder}/part-1.snappy.parquet", single, f"{single}/part-0.parquet", "hdfs://x/other.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(M.file_month(F.col("p"))).collect()] == ["2031-06"] * 3 + [""]
