"""Reading and writing post tables as timestamped snapshots."""

from __future__ import annotations

import datetime as dt
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from stormledger.runtime import cut
from stormledger.schemas import POSTS


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_posts(spark: SparkSession, path: str, schema: T.StructType = POSTS) -> DataFrame:
    """Header CSV with quoted multi-line fields, all columns as in ``schema``.

    Columns are taken by header name when the file has others as well.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same CSV dialect with every header column as a string."""
    if isinstance(path, str) and not _exists(spark, path):
        raise FileNotFoundError(path)
    return (
        spark.read.option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("inferSchema", False)
        .csv(path)
    )


def _entries(spark: SparkSession, folder: str) -> list:
    """Hadoop's status of the folder's own entries; none if it is absent."""
    if not _exists(spark, folder):
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return list(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where))


def snapshot_inventory(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(path, modified, bytes)`` of the folder's own files; no rows if it is absent."""
    rows = [
        (e.getPath().toString(), e.getModificationTime(), e.getLen())
        for e in _entries(spark, folder) if e.isFile() and fnmatchcase(e.getPath().getName(), pattern)
    ]
    listed = spark.createDataFrame(rows, "path string, modified bigint, bytes bigint")
    return listed.select("path", F.timestamp_millis("modified").alias("modified"), "bytes")


def latest_path(spark: SparkSession, folder: str, prefix: str, sep: str = "_") -> str:
    """Newest snapshot: a ``{prefix}_*.csv`` file, or a folder ``{prefix}_*`` with all its parts.

    The later name wins when times are equal.
    """
    found = [
        (e.getModificationTime(), e.getPath().getName(), e.getPath().toString())
        for e in _entries(spark, folder)
        if e.getPath().getName().startswith(prefix + sep) and (e.isDirectory() or e.getPath().getName().endswith(".csv"))
    ]
    if not found:
        raise FileNotFoundError(f"no snapshot {prefix}{sep}* in {folder}")
    return max(found)[2]


def read_latest(spark: SparkSession, folder: str, prefix: str, sep: str = "_") -> DataFrame:
    """All rows of the newest snapshot."""
    return read_table(spark, latest_path(spark, folder, prefix, sep))


def snapshot_path(root: str, name: str, run_ts: dt.datetime) -> str:
    return f"{root.rstrip('/')}/{name}/run_ts={run_ts:%Y-%m-%d_%H%M}"


def write_snapshot(
    df: DataFrame, root: str, name: str, run_ts: dt.datetime, fmt: str = "parquet"
) -> str:
    """Write one run's table and return its path; an existing run is never replaced."""
    path = snapshot_path(root, name, run_ts)
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').option(
            "emptyValue", ""
        ).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def newest_run(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of the latest written run of a Parquet snapshot; runs are told apart by their names."""
    runs = [e.getPath() for e in _entries(spark, f"{root}/{name}") if e.getPath().getName().startswith("run_ts=")]
    if not runs:
        raise FileNotFoundError(f"no run of {name} in {root}")
    return spark.read.parquet(max(runs, key=lambda p: p.getName()).toString())


def with_row_index(df: DataFrame, index_col: str) -> DataFrame:
    """Adds 0, 1, 2, ... in the present order of the rows, without bringing them together.

    Rows are written once with their partition and their place in it; the counts of the
    partitions before give each partition its first number.
    """
    placed = cut(df.withColumn("_at", F.monotonically_increasing_id()), "row-index")
    part = F.shiftright("_at", 33)
    counted = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part).join(firsts, "_part")
        .withColumn(index_col, F.col("_first") + own).drop("_at", "_part", "_first")
    )


def union_posts(*frames: DataFrame, index_col: str | None = None) -> DataFrame:
    """All rows of all captures; a column one of them lacks is null there.

    ``index_col`` names a new row number over all of them, in capture order.
    """
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return with_row_index(every, index_col) if index_col else every


def _checked(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what} table lacks {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def load_spans(df: DataFrame) -> DataFrame:
    from stormledger.schemas import SPANS

    return _checked(df, SPANS, "span")


def load_scores(df: DataFrame) -> DataFrame:
    from stormledger.schemas import SCORES

    return _checked(df, SCORES, "score")
