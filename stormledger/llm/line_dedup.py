"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

A run is a stored table of line hashes, bucketed and sorted by hash, with the number of
documents that hold the line and the largest doc_id among them. All runs have the same
buckets, so they merge bucket by bucket in their order, without being shuffled or sorted
again. Documents come in batches of falling doc_id. A batch is merged with the
runs: a line that no run holds is new and its holder in this batch has the largest doc_id
of all; a known one only adds to the count. Then the batch's own run is added. Runs of a
level are merged into one of the next level whenever there are ``fanout`` of them.

Texts are split into lines once: hashes of the lines that are long enough are written, and
batches and decisions read these. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at
both ends, with A-Z lower-cased; hashes have 128 bits. Each row is a document. Null or empty
text: one empty line, too short to be dropped. Null doc_id: smaller than any other. Repeated
rows count each; all rows of the doc_id that keeps a line keep it. An empty table
gives an empty one; other columns are left as they are.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormledger.runtime import cut_at, drop_scratch, scratch_path

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
BATCHES = 4
FANOUT = 2
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_SPACE))
    # lower() knows more than A-Z, but not in a line of one-byte characters
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, print, lines): a hash of each text, and (at, h1, h2) of its lines of ``least_chars`` code points or more."""
    keys = F.transform(lines_of(F.col("text")), lambda line, at: F.struct(at.alias("at"), line_key(line).alias("key")))
    long = F.filter(keys, lambda x: F.length(x["key"]) >= least_chars)
    return docs.select("doc_id", F.xxhash64("text").alias("print"), F.transform(long, lambda x: F.struct(x["at"].alias("at"), *_hashed(x["key"]))).alias("lines"))


def held_lines(lines: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, last_doc) of ``hashed_lines``: every line key once per document."""
    once = F.array_distinct(F.transform("lines", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))
    return (
        lines.select("doc_id", F.explode(once).alias("line")).select("doc_id", "line.h1", "line.h2")
        .groupBy(*_HASH).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    )


@contextlib.contextmanager
def in_order(spark: SparkSession) -> Iterator[None]:
    """Plans made inside take a bucket of one file as sorted, as it was written."""
    before = spark.conf.get(_ORDERED)
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(_ORDERED, before)


class LineRuns:
    """Levelled runs in the shared folder of the session: tables bucketed and sorted by line hash."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many as a grouped batch has parts
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, run: DataFrame, level: int) -> None:
        """A run whose rows of one bucket lie in one task, so that each bucket is one sorted file."""
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, f"line-run-{level}")
        with in_order(self.spark):
            run.write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        drop_scratch(self.spark, run[1])

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def known(self, held: DataFrame) -> DataFrame:
        """A batch's lines, merged with each run in turn: those that a run holds lose their holder."""
        found = F.lit(False)
        for k, run in enumerate(self.tables()):
            held = held.join(run.select(*_HASH, F.lit(True).alias(f"in{k}")).hint("merge"), _HASH, "left")
            found = found | F.col(f"in{k}").isNotNull()
        return held.select(*_HASH, "n_docs", F.when(~found, F.col("last_doc")).alias("last_doc"))

    def add(self, held: DataFrame) -> None:
        """Merge a batch's ``held`` lines with the runs, add its run, compact full levels.

        Lines that the runs hold keep their holder and only add to the count.
        """
        self._write(self.known(held), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._compact([level], level + 1)
            level += 1

    def _compact(self, levels: list[int], into: int) -> None:
        """All runs of some levels merged into one, two at a time, bucket by bucket."""
        full = [run for level in levels for run in self.levels[level]]
        for level in levels:
            self.levels[level] = []
        while len(full) > 1:
            a, b = (self.spark.table(name).alias(tag) for (name, _), tag in zip(full[:2], "ab", strict=True))
            same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
            count = F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))
            both = a.join(b.hint("merge"), same, "full_outer").select(
                *[F.coalesce(f"a.{h}", f"b.{h}").alias(h) for h in _HASH], count.alias("n_docs"), F.greatest("a.last_doc", "b.last_doc").alias("last_doc")
            )
            self._write(both, into)
            for run in full[:2]:
                self._drop(run)
            full = full[2:] + [self.levels[into].pop()]
        while len(self.levels) <= into:
            self.levels.append([])
        self.levels[into] += full

    def whole(self) -> DataFrame:
        """All lines in one run."""
        self._compact(list(range(len(self.levels))), len(self.levels))
        return self.tables()[0]

    def drop(self) -> None:
        for level in self.levels:
            for run in level:
                self._drop(run)
        self.levels = []


def _batches(docs: DataFrame, batches: int) -> list[DataFrame]:
    """Parts of about equal size by falling doc_id."""
    edges = docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    edges = sorted(set(edges), reverse=True)
    parts, above = [], None
    for edge in [*edges, None]:
        keep = F.lit(True) if edge is None else F.col("doc_id") > edge
        if edge is None:
            keep = F.col("doc_id").isNull() | (F.lit(True) if above is None else F.col("doc_id") <= above)
        elif above is not None:
            keep = keep & (F.col("doc_id") <= above)
        parts.append(docs.filter(keep))
        above = edge
    return parts


def dropped_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """(d, p, gone): for documents that lose lines, by doc_id and text hash, the numbers of those lines."""
    spark = docs.sparkSession
    lines, lines_path = cut_at(hashed_lines(docs.select("doc_id", "text"), least_chars), "line-hashes")
    runs = LineRuns(spark, fanout)
    for part in _batches(lines, batches):
        runs.add(held_lines(part))
    common = runs.whole().filter(F.col("n_docs") >= least_documents).select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "last_doc")
    common, common_path = cut_at(common, "line-common")
    runs.drop()
    placed = lines.select("doc_id", "print", F.explode("lines").alias("line")).select("doc_id", "print", "line.at", "line.h1", "line.h2")
    lost = placed.join(common, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    gone, _ = cut_at(lost.groupBy(F.col("doc_id").alias("d"), F.col("print").alias("p")).agg(F.collect_set("at").alias("gone")), "line-gone")
    drop_scratch(spark, lines_path)
    drop_scratch(spark, common_path)
    return gone


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with ``text`` without its dropped lines, and n_lines, n_dropped.

    A document that loses all its lines has empty text. Options: see ``dropped_lines``.
    """
    lost = dropped_lines(docs, **options)
    same = docs["doc_id"].eqNullSafe(F.col("d")) & (F.xxhash64(docs["text"]) == F.col("p"))
    lines = lines_of(docs["text"])
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), docs["text"]).otherwise(F.array_join(F.transform(kept, lambda at: F.get("__lines", at)), "\n"))
    joined = docs.join(lost, same, "left").withColumn("__lines", lines)
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *columns, F.size("__lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")
    )
