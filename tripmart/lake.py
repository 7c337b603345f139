"""Where each layer lives. A lake is a root folder; layers are directories below it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripmart.functions import months

# Spark's error conditions for a path that is absent, and for one without a data file.
NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}

# --- Fixed values: table names ------------------------------------------------
MART_NAME = "viajes_por_zona_hora"
NAMED_MART = "viajes_por_zona_hora_con_zona"
CANARY_NAME = "puente_dbt"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Lake:
    root: str

    def raw(self, service: str, month: str | None = None) -> str:
        if month is None:
            return months.raw_root(self.root, service)
        return months.raw_folder(self.root, service, month)

    def raw_file(self, service: str, month: str) -> str:
        return months.raw_object(self.root, service, month)

    def silver(self, service: str) -> str:
        return f"{self.root.rstrip('/')}/silver/tlc_{months.service_name(service)}"

    def gold(self, name: str = MART_NAME) -> str:
        return f"{self.root.rstrip('/')}/gold/{name}"

    def staging(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/_staging/{layer}/{name}"

    def published(self, service: str) -> str:
        return f"{self.root.rstrip('/')}/published/tlc_{months.service_name(service)}"

    def landing(self, name: str = "ledger") -> str:
        return f"{self.root.rstrip('/')}/raw/_ledger/{name}"


def nothing_there(err: AnalysisException) -> bool:
    """Whether a read failed because nothing has been written at its path yet."""
    return (err.getCondition() or "").split(".")[0] in NOTHING_THERE


def _hadoop_fs(spark: SparkSession, path: str):
    """(file system, path) through the session's JVM, or None where the JVM is not
    reachable from Python (Spark Connect); callers then fall back to reads."""
    jvm = getattr(spark, "_jvm", None)
    jsc = getattr(spark.sparkContext, "_jsc", None) if jvm is not None else None
    if jvm is None or jsc is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, or None when the file system is not at hand."""
    handle = _hadoop_fs(spark, path)
    return None if handle is None else bool(handle[0].exists(handle[1]))


def list_dirs(spark: SparkSession, pattern: str) -> list[str] | None:
    """Names of the folders matching a glob (one listing call, no file walk)."""
    handle = _hadoop_fs(spark, pattern)
    if handle is None:
        return None
    statuses = handle[0].globStatus(handle[1])
    return [] if statuses is None else [st.getPath().getName() for st in statuses if st.isDirectory()]


def month_folders(spark: SparkSession, root: str) -> list[str] | None:
    """Months present as ``mes=YYYY-MM`` folders of a partitioned table, or None
    when the file system is not reachable from the driver."""
    try:
        names = list_dirs(spark, f"{root.rstrip('/')}/mes=*")
    except Exception:  # noqa: BLE001 - caller falls back to Spark's listing
        return None
    if names is None:
        return None
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("mes="))


def drop_months(spark: SparkSession, root: str, gone) -> None:
    """Remove the given month folders of a partitioned table."""
    for m in gone:
        handle = _hadoop_fs(spark, f"{root.rstrip('/')}/mes={m}")
        if handle is None:
            raise RuntimeError(f"cannot remove month {m} of {root}: its file system is out of reach")
        handle[0].delete(handle[1], True)


def drop_tree(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library made (staging); False where it is out of reach."""
    handle = _hadoop_fs(spark, path)
    return handle is not None and bool(handle[0].delete(handle[1], True))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, making the folder of its new place."""
    fs, start = _hadoop_fs(spark, source)
    _, end = _hadoop_fs(spark, target)
    fs.mkdirs(end.getParent())
    if not fs.rename(start, end):
        raise OSError(f"could not move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, hpath = _hadoop_fs(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file whole or not at all; False if it exists already.

    It is written aside and renamed without overwriting, which a file system with atomic
    renames decides for one of several writers.
    """
    handle = _hadoop_fs(spark, path)
    if handle is None:
        raise RuntimeError(f"cannot write {path}: its file system is out of reach")
    fs, final = handle
    if fs.exists(final):
        return False
    aside = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_{uuid.uuid4().hex}")
    fs.mkdirs(final.getParent())
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(final), options)
    except Py4JJavaError as err:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in str(err.java_exception.getClass().getName()):
            return False
        raise
    return True


def file_names(spark: SparkSession, pattern: str) -> list[str] | None:
    """Names of the files and folders matching a glob."""
    handle = _hadoop_fs(spark, pattern)
    if handle is None:
        return None
    return [st.getPath().getName() for st in handle[0].globStatus(handle[1]) or []]


def read_months(spark: SparkSession, root: str, months) -> DataFrame:
    """Read only the given month partitions of a table (``mes`` kept as a column).

    Only those folders are listed, so the cost does not grow with the number of
    months the table holds.
    """
    root = root.rstrip("/")
    return spark.read.option("basePath", root).parquet(*[f"{root}/mes={m}" for m in months])


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a table.

    With the driver's file system at hand, the folder's existence decides (no
    listing of the table's files); otherwise the schema must resolve.
    """
    try:
        found = path_exists(spark, path)
        if found is not None:
            return found
    except Exception:  # noqa: BLE001 - fall back to reading
        pass
    try:
        _ = spark.read.parquet(path).schema
        return True
    except AnalysisException as err:
        if nothing_there(err):
            return False
        raise
