import pytest

from tripmart.session import NoSharedFolder, configure, scratch, shared_dir


def test_scratch_lives_below_the_shared_folder(spark):
    base = shared_dir(spark)
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one.startswith(base + "/tripmart/x-") and two.startswith(base + "/tripmart/x-") and one != two


def test_configure_pins_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


class _Cluster:
    """A session on a cluster master, with or without a named folder."""

    def __init__(self, named=None, master="spark://head:7077"):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        raise AssertionError(f"a folder of its own on a cluster: {path}")


@pytest.mark.parametrize("master", ["spark://head:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused_before_any_write(master):
    with pytest.raises(NoSharedFolder, match="spark.checkpoint.dir"):
        scratch(_Cluster(master=master), "x")


def test_the_named_folder_is_used():
    assert shared_dir(_Cluster("s3a://bucket/ckpt/")) == "s3a://bucket/ckpt"


def test_cluster_settings_can_be_set(spark):
    from tripmart.session import CLUSTER_CONF

    for key, value in CLUSTER_CONF.items():
        if key.startswith("spark.sql."):
            before = spark.conf.get(key)
            try:
                spark.conf.set(key, value)
            finally:
                spark.conf.set(key, before)


def test_configure_keeps_methods_within_what_hotspot_compiles(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "65535")
    assert configure(spark).conf.get(key) == "8000"


def test_months_are_written_side_by_side_and_the_setting_returns(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.readwriter import DataFrameWriter

    from tripmart import session
    from tripmart.lake import Lake
    from tripmart.operators import silver

    key = "spark.sql.maxConcurrentOutputFileWriters"
    seen, plain = [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        seen.append(spark.conf.get(key))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    monkeypatch.setattr(session, "OPEN_MONTHS", 2)  # the other months of a task are sorted
    before = spark.conf.get(key)
    month = F.format_string("2001-%02d", F.col("id") % 5 + 1)
    rows = spark.range(0, 1000, 1, 1)
    silver.write_months(rows.withColumn("mes", month), str(tmp_path / "table"))
    raw = rows.withColumn("mes_archivo", month)
    silver.land_raw(raw, Lake(str(tmp_path / "folders")))
    months = silver.land_single_files(raw, Lake(str(tmp_path / "files")))
    assert seen == ["2"] * 3 and spark.conf.get(key) == before
    assert months == [f"2001-{i:02d}" for i in range(1, 6)]
    for path in (tmp_path / "table", silver.Lake(str(tmp_path / "folders")).raw("yellow")):
        got = spark.read.parquet(str(path)).select("id", "mes").collect()
        assert sorted(map(tuple, got)) == [(i, f"2001-{i % 5 + 1:02d}") for i in range(1000)]
    files = Lake(str(tmp_path / "files"))
    for i, m in enumerate(months):
        assert sorted(r.id for r in spark.read.parquet(files.raw_file("yellow", m)).collect()) == list(range(i, 1000, 5))


def test_landing_by_month_shuffles_into_few_enough_partitions_to_be_written_unsorted(spark, tmp_path, monkeypatch):
    import re

    from pyspark.sql import functions as F
    from pyspark.sql.readwriter import DataFrameWriter

    from tripmart.lake import Lake
    from tripmart.operators import silver

    dealt, plain = [], DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        plan = self._df._jdf.queryExecution().executedPlan().toString()
        dealt.extend(re.findall(r"hashpartitioning\(mes#\d+, (\d+)\)", plan))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    month = F.when(F.col("id") % 7 > 0, F.format_string("2001-%02d", F.col("id") % 7))
    raw = spark.range(0, 1000, 1, 3).withColumn("mes_archivo", month)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        for n in ("400", "5"):
            spark.conf.set(key, n)
            lake = Lake(str(tmp_path / n))
            silver.land_raw(raw, lake)
            got = spark.read.parquet(lake.raw("yellow")).select("id", "mes").collect()
            assert sorted(r.id for r in got) == list(range(1000))
            assert all(r.mes == (f"2001-{r.id % 7:02d}" if r.id % 7 else None) for r in got)
            files = Lake(str(tmp_path / f"files-{n}"))
            months = silver.land_single_files(raw.where("mes_archivo IS NOT NULL"), files)
            assert months == [f"2001-{i:02d}" for i in range(1, 7)]
            for i, m in enumerate(months, start=1):
                held = spark.read.parquet(files.raw_file("yellow", m)).collect()
                assert sorted(r.id for r in held) == list(range(i, 1000, 7))
        assert dealt == ["200", "200", "5", "5"]
    finally:
        spark.conf.set(key, before)
