"""Spelling variants by blocked Gram matrices over letter counts.

Two words one edit apart have letter counts at a squared distance of 1 (a letter
more or less) or 2 (one letter for another). Words lie in blocks that agree in
length and in the number of letters of each letter group; an edit takes one letter
from at most one group and gives one to at most one, so each block meets only the
blocks that such a step leads to, of its own length or the next. A pair of blocks is
one NumPy product of the two letter-count matrices, which gives all squared distances;
pairs at most two apart are kept and their edits verified position by position. Blocks
that would be too large are dealt into several, all of which meet.

Words come from the whole texts: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z
lower-cased. A run whose crc32 of ``<doc_id>:<run>`` is divisible by ``noise`` loses one
letter, as spelling mistakes of known kind to be found again; ``noise`` = 0 leaves all
as they are.

Null or empty text: no words. Null doc_id: the empty string in ``<doc_id>:<run>``. Each
row is a document, so repeated rows count each. Words of equal number: the smaller in
code point order is the form. An empty table gives an empty one; other columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormledger.runtime import cut_at, drop_scratch

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LETTERS = 6
LEAST_TIMES = 5
NOISE = 199
FORM_TIMES = 5  # a form occurs so many times as often as its variant
BLOCK_WORDS = 512
# letters of about equal frequency in each group; all beyond z are dealt out in turn
GROUPS = ["ezj", "tuwq", "anbx", "idyk", "oslv", "rhcmgfp"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _group_letters() -> list[str]:
    groups = list(GROUPS)
    for at in range(0xC0, 0x100):
        groups[at % len(groups)] += chr(at)
    return groups


def runs_of(text: Column) -> Column:
    """Array of all letter runs of a text, A-Z lower-cased."""
    plain = F.octet_length(text) == F.length(text)
    # lower() knows more than A-Z, but not in a text of one-byte characters
    folded = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(folded, F.lit(RUN), F.lit(0))


def misspelt(doc_id: Column, run: Column, noise: int = NOISE) -> Column:
    """The run without its letter number h % length where ``noise`` divides h, the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % noise == 0, short).otherwise(run)


def word_counts(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, noise: int = NOISE
) -> DataFrame:
    """(word, n) of the words with at least so many letters and occurrences."""
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    long = F.filter(runs_of(F.col("text")), lambda r: F.length(r) >= least_letters)
    each = slim.select("doc_id", F.explode(long).alias("run"))
    word = misspelt(F.col("doc_id"), F.col("run"), noise) if noise else F.col("run")
    return (
        each.select(word.alias("word")).filter(F.length("word") >= least_letters)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_times)
    )


def _signature(word: Column) -> Column:
    """Number of letters of each group, as one array; its sum is the word's length."""
    counts = [F.length(word) - F.length(F.translate(word, g, "")) for g in _group_letters()]
    known = counts[0]
    for c in counts[1:]:
        known = known + c
    return F.array(*counts, F.length(word) - known)  # the last is for letters that no group lists


def _blocks(words: DataFrame, block_words: int) -> DataFrame:
    """(sig, part, words, times): blocks of about ``block_words`` words of one signature."""
    signed = words.select("word", "n", _signature(F.col("word")).alias("sig"))
    sizes = signed.groupBy(F.col("sig").alias("s")).agg(F.ceil(F.count("*") / block_words).alias("parts"))
    dealt = signed.join(sizes, F.col("sig") == F.col("s")).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    row = F.collect_list(F.struct("word", "n")).alias("held")
    return dealt.groupBy("sig", "part").agg(row).select("sig", "part", F.col("held.word").alias("words"), F.col("held.n").alias("times"))


def _steps(groups: int) -> list[list[int]]:
    """Changes of a signature by one edit, each unordered pair of blocks once: none, a letter of another group, a letter more."""
    out = [[0] * groups]
    for i in range(groups):
        more = [0] * groups
        more[i] = 1
        out.append(more)
        for j in range(i + 1, groups):
            swap = [0] * groups
            swap[i], swap[j] = 1, -1
            out.append(swap)
    return out


def _codes(words: list[str]) -> np.ndarray:
    """Code points, one row a word; all words have the same length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _letter_counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    at = np.searchsorted(letters, codes) + np.arange(len(codes))[:, None] * len(letters)
    return np.bincount(at.ravel(), minlength=len(codes) * len(letters)).reshape(len(codes), -1).astype(np.float32)


def near_in_blocks(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of all a[i], b[j] one edit apart; b has a's length or one more."""
    one, two = _codes(a), _codes(b)
    letters = np.union1d(one, two)
    left, right = _letter_counts(one, letters), _letter_counts(two, letters)
    gram = left @ right.T
    apart = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :] - 2 * gram
    i, j = np.nonzero(apart <= 2)
    x, y = one[i], two[j]
    size = x.shape[1]
    if y.shape[1] == size:
        ok = (x != y).sum(1) == 1
    else:  # x is y without a letter: equal up to some place, and from there on one place later
        ahead = np.cumprod(x == y[:, :size], axis=1).sum(1)
        behind = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
        ok = ahead + behind >= size
    return i[ok], j[ok]


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of words one edit apart."""
    blocks, path = cut_at(_blocks(words, block_words), "spelling-blocks")
    steps = _steps(len(GROUPS) + 1)
    moved = F.explode(F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])).alias("step")
    left = blocks.select("sig", F.col("part").alias("part_a"), F.col("words").alias("a"), F.col("times").alias("na"), moved)
    left = left.withColumn("sig", F.zip_with("sig", "step", lambda x, y: x + y)).filter(F.forall("sig", lambda x: x >= 0))
    own = F.forall("step", lambda x: x == 0)
    right = blocks.select("sig", F.col("part").alias("part_b"), F.col("words").alias("b"), F.col("times").alias("nb"))
    met = left.join(right, "sig").filter(~own | (F.col("part_a") <= F.col("part_b")))
    same = (own & (F.col("part_a") == F.col("part_b"))).alias("same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, na, b, nb = (batch.column(c)[k].values for c in range(4))
                i, j = near_in_blocks(a.to_pylist(), b.to_pylist())
                if batch.column(4)[k].as_py():  # a block with itself: each pair turns up both ways
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                a, na, b, nb = a.take(pa.array(i)), na.take(pa.array(i)), b.take(pa.array(j)), nb.take(pa.array(j))
                for row in ([a, na, b, nb], [b, nb, a, na]):
                    yield pa.RecordBatch.from_arrays(row, ["word", "n", "other", "other_n"])

    pairs = met.select("a", "na", "b", "nb", same).mapInArrow(run, "word string, n long, other string, other_n long")
    pairs, pairs_path = cut_at(pairs, "spelling-pairs")
    drop_scratch(words.sparkSession, path)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the end of their chain of forms, by doubling steps.

    A form occurs at least ``FORM_TIMES`` times as often as its variant, so chains end
    and have at most some 27 links.
    """
    spark = forms.sparkSession
    state, path = cut_at(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = state.select(F.col("word").alias("w"), F.col("root").alias("next"))
        moved = state.join(onward, F.col("root") == F.col("w"), "left")
        if moved.filter("next IS NOT NULL").isEmpty():
            return state
        old = path
        state, path = cut_at(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        drop_scratch(spark, old)


def spelling_groups(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, noise: int = NOISE,
    form_times: int = FORM_TIMES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``word_counts``."""
    words, _ = cut_at(word_counts(docs, least_letters, least_times, noise), "spelling-words")
    near = near_words(words, block_words)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    found = near.groupBy(F.col("word").alias("w")).agg(F.count("*").alias("n_near"), F.max("n").alias("own_n"), best)
    large = -F.col("best.less") >= F.col("own_n") * form_times
    found = found.select(
        "w", "n_near", F.when(large, F.col("best.form")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n")
    )
    found, _ = cut_at(found, "spelling-forms")
    roots = _roots(found.filter("form IS NOT NULL").select(F.col("w").alias("word"), "form"))
    named = found.join(roots.select(F.col("word").alias("r"), "root"), F.col("w") == F.col("r"), "left")
    return words.join(named, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
