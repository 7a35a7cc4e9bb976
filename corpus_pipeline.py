"""Documents to a mixed, tokenized corpus.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its
result is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.llm import bpe, importance, line_dedup, mixing, ngram_join
from stormledger.llm.queries import vocabulary_path
from stormledger.runtime import cut

ORACLE_SQL = None  # SQL expresses neither the resampling nor the tokenizer; tests/llm has the brute force


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling against the labelled good ones; the others go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance.Resampler(docs, labels).kept(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents hold stay in the largest doc_id only.

    ``n_chars`` follows the text. Documents stay, if need be without text.
    """
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents linked by a Jaccard similarity of 0.8 or more."""
    return ngram_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is used; sources weigh 1, 2, 3 in turn."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    keyed = docs.select(F.struct("doc_id", "source").alias("key"), "text")
    tokens = bpe.encode(keyed, vocabulary_path(), key="key", decoded=True)
    return tokens.select(
        "key.doc_id", "key.source", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
