"""Exact duplicates by skew-safe combining.

1. *Census*: digests are counted, first under a salt, then over the salts. Only 32-byte
   digests move. A digest that occurs once stands for one text, so that text never moves.
2. *Members*: rows whose digest repeats are picked by a join on (digest, salt); the salt
   spreads a hot digest over many tasks.
3. *Merging*: rows are deduplicated locally (the map side of the aggregate), merged by
   (salt, digest, whole text), and the salts' winners are merged by (digest, whole text).
   Every step groups by the text itself; a digest alone never makes two rows equal.
4. Winners go back the way they came: one row for each salt that had copies, with the whole
   text, and members meet it by salt, digest and text. So no task holds more than one salt's
   copies of a hot text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. A null text counts as empty.
    Of equal texts the largest doc_id stays; a null doc_id is smaller than any other. Rows
    that repeat doc_id and text are members of their group like others, and the copies of
    the row that stays are all marked kept, as they cannot be told apart; a group without
    any doc_id keeps its rows. Other columns are ignored, whatever their names. An empty
    table gives no rows.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("body"),
    ).select("doc_id", "body", F.sha2("body", 256).alias("digest"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt")

    census = (
        rows.select("digest", salt)
        .groupBy("digest", "salt")
        .agg(F.count("*").alias("n"))
        .groupBy("digest")
        .agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
    )
    repeated = census.filter("n > 1").select("digest", F.explode("salts").alias("salt"))
    members = rows.select("doc_id", "body", "digest", salt).join(repeated, ["digest", "salt"])

    by_salt = (
        members.groupBy("salt", "digest", "body")
        .agg(F.max("doc_id").alias("best"), F.count("*").alias("n"))
        .groupBy("digest", "body")
        .agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_list("salt").alias("salts"))
        .select(F.explode("salts").alias("salt"), "digest", "body", "keep_id", "group_size")
    )
    grouped = members.join(by_salt, ["salt", "digest", "body"]).select("doc_id", "keep_id", "group_size", "digest")
    alone = census.filter("n = 1").select("digest", F.col("salts")[0].alias("salt"))
    single = rows.select("doc_id", "digest", salt).join(alone, ["digest", "salt"]).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest"
    )
    return grouped.unionByName(single).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group, the one ``exact_groups`` keeps; columns as they are."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = exact_groups(docs).filter("kept").select(F.col("keep_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    marked = docs.select(*names, F.sha2(F.coalesce("text", F.lit("")), 256).alias("_digest"))
    same = marked["doc_id"].eqNullSafe(kept["_id"]) & (marked["_digest"] == kept["_sha"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).select(*names)
