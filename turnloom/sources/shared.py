"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a fresh temporary folder is used if the executors run on the
    driver's machine in its own process (a master of ``local``, as in tests). Any other master is
    refused, since its executors would each write to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        found = getattr(shared_dir, "own", None)
        if found is None:
            found = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="turnloom-")
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    if not _scratch:
        atexit.register(release_scratch)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_scratch() -> None:
    """Delete the intermediate tables of this session; call it once their results are stored."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended
            return


def materialize(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``small`` gathers a narrow result into few files of the advisory size, at the price of a
    shuffle of its rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.hint("rebalance") if small else df).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def scratch_mark() -> int:
    """A point in time for ``free_since``."""
    return len(_scratch)


def free_since(mark: int, *keep: DataFrame) -> None:
    """Delete the intermediate tables written since ``mark``, but for those to keep: for a stage
    whose result is stored, when nothing else of the session was begun meanwhile."""
    kept = {table._scratch_path for table in keep}
    for entry in [e for e in _scratch[mark:] if e[1] not in kept]:
        _scratch.remove(entry)
        _delete(*entry)


def free(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and that nothing will read again."""
    for table in tables:
        entry = (table.sparkSession, table._scratch_path)
        if entry in _scratch:
            _scratch.remove(entry)
            _delete(*entry)
