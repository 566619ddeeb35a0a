"""A corpus from raw documents to packed sequences.

Every stage takes all documents that the one before has kept and returns documents; the last
one returns the pieces of the packed sequences. Documents have ``doc_id, text, lang, source,
n_chars``; further columns go along with them, whatever their names, up to the last stage.

Null texts count as empty. A row without a doc_id is a document like others; only where ids
decide (which near copy stays, which passage was first) it stands alone and stays as it is.
Rows that repeat a doc_id are one document there, and rows of their own elsewhere. Empty
tables give empty tables. Texts of any length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import exact_dedup, near_dedup, packing, passages, quality
from granary.llm.shared import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts get the score of a text without n-grams. Without labels of both
    kinds nothing is rejected or, if all labels are 0, everything.
    """
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id.

    Null texts are equal to empty ones. A null id is smaller than any other; of rows that
    repeat id and text one stays.
    """
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id.

    Texts without words and rows without an id are near to nothing and stay. Rows that repeat
    the id that stays all stay.
    """
    return near_dedup.drop_near_copies(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those with nothing left go.

    A text that loses nothing stays byte by byte, also one without words; a null text becomes
    an empty one. Of others the words that stay are joined by one space. ``n_chars`` follows
    the text; all other columns are kept.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    plain = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_other{i}") for i, c in enumerate(others)])
    out = passages.remove_repeated(plain, carry=tuple(plain.columns[2:]), as_is=True).filter("n_removed = 0 or n_removed < n_words")
    held = {c: F.col(f"_other{i}") for i, c in enumerate(others)}
    held |= {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[held[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in sequences of 1024 ids, every window in the mixture of the sources.

    Null and empty texts are the id 0 alone, a null source is a source, and rows that repeat an
    id are packed like others.
    """
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("passages", without_repeated_passages),
    ("packing", packed),
]

#: A fitted classifier and a tokenizer are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
