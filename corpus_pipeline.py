"""From raw documents to token ids: filter, deduplicate, decontaminate, encode.

Each stage takes ``(spark, docs, sf_dir)`` and works on what the stage before it kept. All but the last
return the columns of their ``docs``. Null and empty texts, repeated rows, empty tables and further columns
are handled as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabularium.llm import bpe, decontamination, minhash, sentences, toxicity
from tabularium.llm.tables import keep, mark, release, release_since

#: Documents that score this much or more go.
TOXIC = 0.3
#: Similarity of shingle sets from which on documents are near copies.
NEAR_PERCENT = 80
#: Consecutive words that a passage shares with a benchmark item.
WINDOW = 10


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, learned from the labels, does not find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    machine = toxicity.learn(docs, labels)
    return docs.where(toxicity.score(F.col("text"), machine) < TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.keep_one(docs, NEAR_PERCENT)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentences of passages that an earlier document holds."""
    return sentences.without_repeats(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of benchmark items; documents that are little else go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.decontaminate(docs, items, WINDOW)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the token ids and their number, and whether they decode to the text again."""
    tokenizer = bpe.read_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    text = F.coalesce("text", F.lit(""))
    coded = docs.select("doc_id", text.alias("text"), bpe.encode_decode(F.col("text"), tokenizer).alias("coded"))
    return coded.select(
        "doc_id",
        F.expr("octet_length(coded.ids) div 4").alias("n_tokens"),
        F.col("coded.ids").alias("ids"),
        (F.col("coded.text") == F.col("text")).alias("decodes"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_benchmark_passages),
    ("bpe encoding and decoding", encode_and_decode),
]

#: None: learned weights, merges and groups have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        begin = mark()
        before, docs = docs, keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        release_since(spark, begin, docs)
        release(before)
    return docs
