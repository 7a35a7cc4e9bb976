"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, one in
``2**FRACTION_LOG2``, whatever the text's length. Sketches merge by union, and the share of one
inside another estimates containment however unequal the documents are. An estimate
from k kept hashes has a standard deviation of at most 1 / (2 * sqrt(k)), so short texts are
told apart coarsely. The fingerprint also names the fraction and a 64-bit key of the whole
set, so that equal sets are known; two sketches of different fractions are compared below
the smaller. Equal texts have equal fingerprints.

Null or empty text: an empty sketch; two empty sketches are alike (1), an empty and
a filled one are not (0). If neither has a hash below the common fraction, likeness is
1 for equal sets and else 0. Rows are ordered by falling doc_id, null last, equal ids by
text; repeated rows are documents of their own. An empty table gives an empty one;
other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from stormledger.llm.shingles import set_key, shingle_sets

FRACTION_LOG2 = 2  # one hash in 2**2 is kept
_U = np.uint64


class Sketch(NamedTuple):
    scale: int  # the fraction as a negative power of two
    kept: np.ndarray  # hashes in order
    key: int | None = None  # of the whole set, 0 for the empty one; unknown after a merge


def sketch(hashes: np.ndarray, fraction_log2: int = FRACTION_LOG2) -> Sketch:
    """The sketch of the sorted distinct shingle hashes."""
    return Sketch(fraction_log2, _below(hashes, fraction_log2), set_key(hashes))


def spell(one: Sketch) -> str:
    """The fingerprint: fraction, key of the whole set, then the kept hashes in base 64."""
    return f"{one.scale}:{'' if one.key is None else one.key}:" + base64.b64encode(one.kept.astype("<u8").tobytes()).decode()


def read(fingerprint: str) -> Sketch:
    scale, key, body = fingerprint.split(":")
    return Sketch(int(scale), np.frombuffer(base64.b64decode(body), "<u8"), int(key) if key else None)


def _below(kept: np.ndarray, scale: int) -> np.ndarray:
    return kept if not scale else kept[: np.searchsorted(kept, _U(1 << (64 - scale)))]


def _same(a: Sketch, b: Sketch) -> bool:
    return a.key == b.key if a.key is not None and b.key is not None else a.scale == b.scale and np.array_equal(a.kept, b.kept)


def common(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    """Sizes of both sketches and of their intersection below the smaller fraction."""
    scale = max(a.scale, b.scale)
    x, y = _below(a.kept, scale), _below(b.kept, scale)
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated Jaccard similarity; 1 for equal sets."""
    x, y, both = common(a, b)
    return both / (x + y - both) if x + y and not _same(a, b) else float(_same(a, b))


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated share of a's shingles that b holds."""
    x, _, both = common(a, b)
    return both / x if x else float(a.key == 0 or _same(a, b))


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of the union, of the smaller fraction."""
    scale = max(a.scale, b.scale)
    return Sketch(scale, np.union1d(_below(a.kept, scale), _below(b.kept, scale)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` of each whole text."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([spell(sketch(s)) for s in shingle_sets(batch.column(1))], pa.string())], ["key", "fingerprint"]
            )

    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, fingerprint string").select(F.col("key").alias(key), "fingerprint")


@pandas_udf(T.DoubleType())
def fingerprint_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else likeness(read(x), read(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(T.DoubleType())
def fingerprint_containment(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else containment(read(x), read(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, part, ghost), one partition per ``part``: falling doc_id within and over the parts.

    Ids alone are sorted first, which gives every part's range; each text then moves once.
    Behind the rows of a part follows a ghost of the next part's first row (behind
    the last part: the very first row). Ranges are known to the driver, a few numbers each.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = slim.filter("doc_id IS NOT NULL").select("doc_id").repartitionByRange(parts, "doc_id")
    edges = [r[0] for r in ids.groupBy(F.spark_partition_id().alias("p")).agg(F.max("doc_id").alias("top")).orderBy("top").select("top").collect()]
    tops = np.array(edges[:-1] if edges else [], np.int64)

    @pandas_udf(T.IntegerType())
    def part_of(doc_id: pd.Series) -> pd.Series:
        known = doc_id.fillna(0).astype("int64").to_numpy()
        return pd.Series(np.where(doc_id.isna(), len(tops), len(tops) - np.searchsorted(tops, known, "left")), dtype="int32")

    placed = slim.withColumn("part", part_of("doc_id"))
    first = W.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), F.col("print"))
    # heads are found on numbers alone, then their texts are fetched
    marks = placed.select("part", "doc_id", F.xxhash64("text").alias("print")).withColumn("n", F.row_number().over(first)).filter("n = 1")
    heads = sorted((r.part, r.doc_id, r["print"]) for r in marks.select("part", "doc_id", "print").collect())
    before = {heads[k]: heads[k - 1][0] for k in range(len(heads))}
    if not heads:
        return slim.withColumn("part", F.lit(0)).withColumn("print", F.lit(0).cast("long")).withColumn("ghost", F.lit(False))
    wanted = [h[1] for h in heads if h[1] is not None]
    near = slim.filter(F.col("doc_id").isin(wanted) | (F.lit(any(h[1] is None for h in heads)) & F.col("doc_id").isNull()))
    table = spark.createDataFrame([(i, p, to) for (_, i, p), to in before.items()], "i long, p long, part int")
    ghosts = near.withColumn("print", F.xxhash64("text")).join(table, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("print") == F.col("p")))
    ghosts = ghosts.dropDuplicates(["part"]).select("doc_id", "text", "part", "print", F.lit(True).alias("ghost"))
    whole = placed.select("doc_id", "text", "part", F.xxhash64("text").alias("print"), F.lit(False).alias("ghost"))
    return whole.union(ghosts).repartitionById(len(tops) + 1, F.col("part")).sortWithinPartitions(
        "part", "ghost", F.col("doc_id").desc_nulls_last(), "print"
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text: the last half of the code points (rounded down) gives way to the
    first as many, or all, of the next document by falling doc_id; after the last comes the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that waits for its next one: (part, ghost, doc_id, text, sketch)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, texts, parts, ghosts = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(4).to_pylist()
                ready = []
                for row in zip(parts, ghosts, ids, texts, (sketch(s) for s in shingle_sets(part.column(1))), strict=True):
                    if last is not None and not last[1] and last[0] == row[0]:
                        ready.append((last, row))
                    last = row
                if ready:
                    yield _rows(ready)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(run, schema)


def _rows(pairs: list) -> pa.RecordBatch:
    edited = []
    for (_, _, _, text, _), (_, _, _, after, _) in pairs:
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    sketches = [sketch(s) for s in shingle_sets(pa.array(edited, pa.string()))]
    columns = [
        pa.array([own[2] for own, _ in pairs], pa.int64()),
        pa.array([len(own[3]) for own, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array([spell(own[4]) for own, _ in pairs]),
        pa.array([spell(s) for s in sketches]),
        pa.array([likeness(own[4], s) for (own, _), s in zip(pairs, sketches, strict=True)]),
        pa.array([likeness(own[4], after[4]) for own, after in pairs]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
