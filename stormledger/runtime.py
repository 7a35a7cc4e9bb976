"""Scratch space and lineage cuts that outlive a lost executor."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_open_scratch: list[list[str]] = []


@contextlib.contextmanager
def scratch() -> Iterator[list[str]]:
    """Deletes, at its end, the tables that were cut inside it; what is taken off the list stays.

    Results that are read lazily keep their scratch tables. A caller who runs operators and writes
    their results inside this leaves nothing behind.
    """
    written: list[str] = []
    _open_scratch.append(written)
    try:
        yield written
    finally:
        _open_scratch.remove(written)
        session = SparkSession.getActiveSession()
        for path in written if session else []:
            drop_scratch(session, path)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a single-machine
    session (tests) may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="stormledger-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back, ending its lineage; the table and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    for written in _open_scratch:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    return cut_at(df, name)[0]


def cut_all(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Write frames of one schema, each made when the one before is written, and read them back together."""
    path, spark, schema = None, None, None
    for frame in frames:
        if path is None:
            spark, schema = frame.sparkSession, frame.schema
            path = scratch_path(spark, name)
            for written in _open_scratch:
                written.append(path)
        frame.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that nothing reads any more; only paths below the shared folder."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is not a scratch path")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
