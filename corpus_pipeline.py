"""From raw documents to token ids: five stages, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm import byte_bpe, language, mixing, simhash, suffix_dedup
from plantlake.llm.shared import remainder, store


def free_name(docs: DataFrame, name: str) -> str:
    """The name, or where a column has it already, one that none has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language, null or empty texts and others without a letter go.

    A missing lang is filled. Repeated rows stay each, other columns keep name and values, an empty table
    gives an empty one.
    """
    model = language.train(docs, remainder("doc_id", 5) != 0)
    out, score = free_name(docs, "_lang"), free_name(docs, "_score")
    found = language.identify(docs, model, out=out, score=score, keep_text=True)
    found = found.where(F.col(out) != language.UNKNOWN).withColumn("lang", F.coalesce("lang", out))
    return found.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, two bits.

    The smallest doc_id stays, of repeated rows one; texts without words, null ones too, are one group.
    """
    return simhash.keep_first(docs, length=3, distance=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur more than once; no document goes.

    Null and empty texts come out empty; repeated rows each lose what they share. Columns that have the
    names of the operator's own keep their values.
    """
    moved = {c: free_name(docs, f"{c}_") for c in docs.columns if c in suffix_dedup.ADDED}
    cut = suffix_dedup.remove_repeats(docs.withColumnsRenamed(moved), window=200, as_text=True)
    made = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*[made.get(c, F.col(moved.get(c, c))).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 in turn with 150 % of all words: documents left out, once or twice.

    A null source is one of its own; null and empty texts have no words; repeated rows are drawn each.
    """
    return mixing.mix(docs)


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the text they decode to; null counts as empty."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "source", "text"), path), path)
    return decoded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe_encoding", encode_ids),
]

#: No SQL can say these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {"pipeline": run}
LLM_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
