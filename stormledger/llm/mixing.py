"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

All words T of the corpus are dealt to 2**k slots of b = T / 2**k words each. The
van der Corput points of the slots fall through the cumulative targets, which
gives each source its target within one slot and spreads its slots evenly over
the schedule. A source gets one more slot, at its own place of the schedule, and its last
slot is shortened, so that it supplies its target to the word, however small that is. Slots are ranked within their source; a source's documents are
laid end to end in a shuffled order and cut into blocks of b words, again and
again from the start when the target exceeds the source; slot number q of a
source takes its block q.

Hot sources: documents are positioned within (source, shuffle bucket) and slots
ranked within (source, stretch of the schedule); only counts are summed along a
whole source, one per bucket or stretch. One task sees one row per source.

Null source: a source of its own, after all others. Null or empty text: size 0,
never taken. Repeated rows are documents of their own that lie side by side. An
empty table gives an empty one. Other columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stormledger.runtime import cut

WORD = r"[^\x20\x09-\x0D]+"
MOST_REPEATS = 3
BLOCK_WORDS = 1024  # blocks are not longer than this ...
LEAST_SLOTS_LOG2 = 18  # ... and there are at least so many slots, if there are as many words
STRETCH_LOG2 = 16  # slots whose ranks one task counts
BUCKET_ROWS = 10_000  # documents of one shuffle bucket, on average
LEAST_BUCKETS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    all words; a target stops at ``most`` times its source's size and the excess
    is shared out again by weight. Filled like water: sources are taken by
    rising size over weight, and one is full if the level that is left for it
    and all after it reaches its brim.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(most)
    everything = W.partitionBy()
    rising = W.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    rest = rising.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    full = per_source.withColumn("weight", weigh).withColumn("full", level * F.col("weight") >= cap)
    left = total - F.coalesce(F.sum(F.when(F.col("full"), cap)).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.when(F.col("full"), cap).otherwise(left * F.col("weight") / open_weight)
    return full.select("source", "source_size", target.alias("target"))


def reversed_bits(x: Column, bits: int) -> Column:
    """The ``bits`` lowest bits of a number in reverse order: 2**bits times its van der Corput point."""
    for step, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        low, high = F.lit(mask).cast("long"), x
        x = F.shiftleft(high.bitwiseAND(low), step).bitwiseOR(F.shiftrightunsigned(high, step).bitwiseAND(low))
    return F.shiftrightunsigned(x, 64 - bits)


def _positions(sizes: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``start``: the words of the source before each document, in shuffled order."""
    buckets = max(LEAST_BUCKETS, -(-n_rows // BUCKET_ROWS))
    dealt = sizes.withColumn("bucket", F.pmod("shuffled", F.lit(buckets)))
    filled = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    order = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    filled = filled.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(order), F.lit(0)).alias("before")
    )
    inside = W.partitionBy("source", "bucket").orderBy("shuffled", "doc_id", "row").rowsBetween(W.unboundedPreceding, -1)
    return (
        dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(filled, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .select("row", "doc_id", "source", "size", (F.col("before") + F.col("inside")).alias("start"))
    )


def _ranked_slots(targets: DataFrame, slots_log2: int, words: int) -> DataFrame:
    """(source, rank, slot) for all slots of the schedule, and one more of each source."""
    n = 1 << slots_log2
    order = W.orderBy(F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, 0)
    last = F.row_number().over(W.orderBy(F.col("source").isNull().desc(), F.col("source").desc())) == 1
    upto = F.when(last, F.lit(n)).otherwise(F.round(F.sum("target").over(order) * (n / words)).cast("long"))
    owned = targets.withColumn("upto", F.least(upto, F.lit(n))).withColumn(
        "since", F.coalesce(F.lag("upto").over(W.orderBy(F.col("source").isNull(), "source")), F.lit(0))
    )
    width = 1 << min(STRETCH_LOG2, slots_log2)
    pieces = F.sequence(F.floor(F.col("since") / width), F.floor((F.col("upto") - 1) / width))
    extra = owned.filter("target > 0").select(
        "source", (F.col("upto") - F.col("since")).alias("rank"), reversed_bits(F.least("upto", F.lit(n - 1)), slots_log2).alias("slot")
    )
    points = (
        owned.filter("upto > since")
        .select("source", "since", "upto", F.explode(pieces).alias("piece"))
        .repartition("source", "piece")
        .select("source", F.explode(F.sequence(
            F.greatest("since", F.col("piece") * width), F.least(F.col("upto"), (F.col("piece") + 1) * width) - 1
        )).alias("point"))
    )
    slots = points.select("source", reversed_bits(F.col("point"), slots_log2).alias("slot")).withColumn("stretch", F.floor(F.col("slot") / width))
    along = W.partitionBy("source").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    counted = slots.groupBy("source", "stretch").agg(F.count("*").alias("n"))
    counted = counted.select(
        F.col("source").alias("s"), F.col("stretch").alias("t"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before")
    )
    own = F.row_number().over(W.partitionBy("source", "stretch").orderBy("slot"))
    return (
        slots.withColumn("own", own)
        .join(counted, F.col("source").eqNullSafe(F.col("s")) & (F.col("stretch") == F.col("t")))
        .select("source", (F.col("before") + F.col("own") - 1).alias("rank"), "slot")
        .unionByName(extra)
    )


def document_sizes(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(row, doc_id, source, size, shuffled, print) of every document, written once; ``row`` numbers the rows."""
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("shuffled"), F.xxhash64("text").alias("print"),
    )
    return cut(sized, "mix-sizes")


def mix(sizes: DataFrame, targets: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """The schedule: (slot, source, row, doc_id, turn, first_word, n_words).

    Reading the rows by ``slot`` gives the mixed corpus: words ``first_word`` on of
    a document, ``n_words`` of them, for its ``turn``-th use (from 0).
    """
    words, n_rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    least = min(LEAST_SLOTS_LOG2, max(0, words.bit_length() - 1))
    slots_log2 = max(least, (-(-words // BLOCK_WORDS) - 1).bit_length() if words else 0)
    block = max(1.0, words / (1 << slots_log2))
    slots = _ranked_slots(targets, slots_log2, max(1, words))
    supply = targets.select(
        F.col("source").alias("s"), "source_size", F.least(F.round("target").cast("long"), F.col("source_size") * most).alias("supply")
    )
    begin = F.col("turn") * F.col("source_size") + F.col("start")
    laid = (
        _positions(sizes.filter("size > 0"), n_rows)
        .join(supply, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("begin", begin)
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("supply")))
        .filter("end > begin")
        # a block begins at floor(rank * block); the first guess may be one off either way
        .withColumn("from_rank", F.floor(F.col("begin") / block)).withColumn("to_rank", F.floor(F.col("end") / block) + 1)
        .withColumn("rank", F.explode(F.sequence(F.greatest(F.lit(0), F.col("from_rank") - 1), F.col("to_rank"))))
        .withColumn("a", F.greatest(F.col("begin"), F.floor(F.col("rank") * block)))
        .withColumn("z", F.least(F.col("end"), F.floor((F.col("rank") + 1) * block)))
        .filter("z > a")
        .select("source", "rank", "row", "doc_id", "turn", (F.col("a") - F.col("begin")).alias("first_word"), (F.col("z") - F.col("a")).alias("n_words"))
    )
    ranked = slots.select(F.col("source").alias("s"), F.col("rank").alias("r"), "slot")
    return laid.join(ranked, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r"))).select(
        "slot", "source", "row", "doc_id", "turn", "first_word", "n_words"
    )


def words_taken(sizes: DataFrame, targets: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken; and row, print of ``sizes``."""
    taken = mix(sizes, targets, most).groupBy(F.col("row").alias("r")).agg(F.sum("n_words").alias("taken"))
    of_source = targets.select(F.col("source").alias("s"), "source_size", "target")
    return (
        sizes.join(taken, F.col("row") == F.col("r"), "left")
        .join(of_source, F.col("source").eqNullSafe(F.col("s")))
        .select("row", "print", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = MOST_REPEATS) -> DataFrame:
    """The documents of the mix, whole: each as often as its words are taken, begun uses in full.

    A source so exceeds its target by less than one document, and none drops out. Repeated rows (same doc_id and text) share their uses evenly.
    """
    sizes = document_sizes(docs)
    used = words_taken(sizes, source_targets(sizes, weights, most), most).filter("taken > 0")
    uses = used.groupBy(F.col("doc_id").alias("d"), F.col("print").alias("p")).agg(
        F.ceil(F.sum("taken") / F.sum("size")).cast("int").alias("uses")
    )
    same = docs["doc_id"].eqNullSafe(F.col("d")) & (F.xxhash64(docs["text"]) == F.col("p"))
    columns = [docs[c] for c in docs.columns]
    return docs.join(uses, same).select(*columns, F.explode(F.sequence(F.lit(1), F.col("uses"))).alias("__use")).drop("__use")
