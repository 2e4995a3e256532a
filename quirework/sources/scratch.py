"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions, which end with the process.
_local: list[str] = []
#: Scratch folders by application.
_made: dict[str, list[str]] = {}
#: Names of the bucketed tables, by folder.
_named: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the one folder all executors share.

    Without that setting a temporary folder of this machine serves a local master, whose
    driver and executors are one process; on a cluster it would be another folder on each
    machine, so there the lack is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="quirework-"))
            atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
        base = f"file://{_local[0]}"
    path = f"{base.rstrip('/')}/quirework-{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def bucket_count(spark: SparkSession, path: str, each: int = 8 << 20) -> int:
    """How many buckets a table derived from ``path`` is dealt to: as many as a shuffle has, and more
    where one would hold more than ``each`` bytes of the source, so that a task's memory doesn't grow with it."""
    size = sum(n for _, n, _ in fingerprint(spark, path))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def materialize(df: DataFrame, label: str, by: str = "", buckets: int = 0) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage and
    keeps a costly result from being computed twice; it survives the loss of executors.

    With ``by`` the table is bucketed by that column: groups, windows and joins by it need no
    exchange. ``df`` should be dealt out by it already, as rows aren't moved here.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if by:
        name = f"quirework_{label}_{uuid.uuid4().hex}"
        df.write.format("parquet").option("path", path).bucketBy(buckets, by).saveAsTable(name)
        _named[path] = name
        table = spark.table(name)
        table.scratch_path = path
        return table
    schema = df.schema
    df.write.parquet(path)
    table = df.sparkSession.read.schema(schema).parquet(path)
    table.scratch_path = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    if path in _named:
        spark.sql(f"DROP TABLE IF EXISTS {_named.pop(path)}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    _made[table.sparkSession.sparkContext.applicationId].remove(table.scratch_path)
    _delete(table.sparkSession, table.scratch_path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this application, and so the tables that were read from
    them: for the end of a run. Returns how many there were."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """The names, sizes and times of the files of a table: another one once it is rewritten."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return ()
    found, files = [], fs.listFiles(hadoop, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def spread(table: DataFrame, path: str, core_bytes: int = 32 << 20) -> DataFrame:
    """A table of ``path`` dealt out to all cores, if it has less than ``core_bytes`` for each.

    A small file lies in one row group and so in one task, whatever follows; a table large
    enough to keep the cores busy is left as it lies.
    """
    spark = table.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = sum(n for _, n, _ in fingerprint(spark, path))
    return table.repartition(cores) if size < core_bytes * cores else table


class StageTables:
    """Stage tables of a session, written once each and read by the stages after them.

    A stage is known by its source's files, so a rewritten source gives new tables.
    """

    def __init__(self) -> None:
        self.known: dict[tuple, DataFrame] = {}

    def get(self, spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame], by: str = "") -> DataFrame:
        key = (spark.sparkContext.applicationId, fingerprint(spark, source), source, name)
        if key not in self.known:
            self.known[key] = materialize(build(), name, by, bucket_count(spark, source) if by else 0)
        return self.known[key]

    def clear(self) -> None:
        self.known.clear()
