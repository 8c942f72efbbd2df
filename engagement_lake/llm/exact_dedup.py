"""Exact duplicates: rows grouped by a 128-bit content hash, bytes compared inside groups.

A narrow table of keys and hashes gives each group its smallest key and its size. The texts
themselves go through one grouping by (hash, text), which compares them byte by byte; copies meet
in the map task already, so a group that holds a third of all rows costs one row per task. It only
says which hashes stand for more than one text. Those, usually none, are split by text.

Groups of more than a thousandth of all rows, under a thousand groups, are broadcast to their
members; members of all others are joined by hash.

Cases: a null text is empty, and empty texts are equal to one another; a text of white space alone
is one space. The smallest key stays, a null key last; of rows that repeat the smallest key one
stays. Repeated rows are counted and returned each. An empty table gives no rows. Other columns are
left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engagement_lake.llm.store import free_name, read, written

# A group of more than 1 / HOT of all rows is hot: there are fewer than HOT such groups.
HOT = 1000

_WHITE = r"[\x20\x09-\x0D]+"


def one_space(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, _WHITE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normal: Callable[[Column], Column] = one_space,
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """(key, keep_key, group_size, kept, sha256) of every row, ``sha256`` of the normal text in binary.

    ``digest`` may be any function of the text: results are the same, whatever it tells apart.
    """
    bodies = docs.select(
        F.col(f"`{key}`").alias("key"), normal(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("body")
    ).withColumn("hash", digest(F.col("body")))
    hashed = written(_narrow(bodies, F.lit(0)), "hashed")

    same_hash = bodies.select("hash", "body").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("texts"))
    collided = written(same_hash.where("texts > 1").select("hash"), "collided")
    if not collided.isEmpty():
        several = bodies.join(collided, "hash", "left_semi")
        by_text = Window.partitionBy("hash").orderBy("body")
        numbered = several.select("hash", "body").distinct().withColumn("variant", F.row_number().over(by_text))
        split = _narrow(several.join(numbered, ["hash", "body"]), F.col("variant"))
        hashed = written(hashed.join(collided, "hash", "left_anti").unionByName(split), "told_apart")

    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("first")
    groups = written(hashed.groupBy("hash", "variant").agg(first, F.count(F.lit(1)).alias("group_size")), "groups")
    total = hashed.count()
    hot = F.broadcast(groups.where(F.col("group_size") * HOT > total))
    others = groups.where(F.col("group_size") * HOT <= total)
    on = ["hash", "variant"]
    found = hashed.join(hot, on).unionByName(hashed.join(hot, on, "left_anti").join(others, on))
    return found.select(
        "key",
        F.col("first.key").alias("keep_key"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "sha256",
    )


def _narrow(bodies: DataFrame, variant: Column) -> DataFrame:
    """One narrow row per text; ``row`` tells rows apart that are the same in all else."""
    return bodies.select(
        "key",
        "hash",
        variant.cast("int").alias("variant"),
        F.unhex(F.sha2("body", 256)).alias("sha256"),
        F.monotonically_increasing_id().alias("row"),
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Needs keys that tell documents apart; of
    rows that repeat one key with one text, one stays, of different ones with one key, each."""
    kept = exact_groups(docs, key, text).where("kept").select("key", "sha256")
    k, s = free_name(docs.columns, "_key"), free_name(docs.columns, "_sha256")
    body = one_space(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    named = docs.withColumns({k: F.col(f"`{key}`"), s: F.unhex(F.sha2(body, 256))})
    same = named[k].eqNullSafe(kept["key"]) & (named[s] == kept["sha256"])
    return named.join(kept, same, "left_semi").dropDuplicates([k, s]).drop(k, s)


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the one of equal text that stays; cases as the module states them."""
    return exact_groups(read(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"),
        F.col("keep_key").alias("keep_id"),
        "group_size",
        "kept",
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


ORACLE = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
    SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""
