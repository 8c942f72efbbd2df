"""Shuffled shards by a two-pass external shuffle, in built-in functions only.

Pass one scatters rows by seeded hashes: the key and the number of shards decide the shard (the
shard of highest hash wins, so one more shard takes rows only into itself), a hash of the whole row
decides the bucket within it. There are as many buckets as keep one in memory. Pass two brings each
bucket into one task, puts it into Fisher-Yates order and writes it.

Cases: a null text has no bytes, a null key is a key like any other; rows with one key share a shard
but spread over its buckets, unless they are equal in every column; other columns are kept, whatever
their names, and must be orderable. An empty table gives readable, empty shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from engagement_lake.llm.store import read, scratch_path, shuffles_dropped

SHARDS = 16
# Text that a bucket should hold, and rows beside it; both fit one task's memory several times.
BUCKET_BYTES = 24 << 20
BUCKET_ROWS = 100_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard in 0 to ``shards`` - 1 whose hash with the key is highest."""
    tickets = [
        F.struct(F.xxhash64(key, F.lit(seed), F.lit(s)).alias("ticket"), F.lit(s).alias("shard"))
        for s in range(shards)
    ]
    return F.array_max(F.array(*tickets))["shard"]


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    seed: int = 8,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write all rows below ``path/shard=N``, as (bucket, position, row)."""
    whole = docs.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")
    ).head()
    wanted = max(whole["bytes"] / bucket_bytes, whole["rows"] / BUCKET_ROWS)
    buckets = max(1, -(-int(wanted) // shards))  # of each shard

    scatter = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns], F.lit(seed))
    rows = docs.select(
        shard_of(F.col(key), shards, seed).alias("shard"),
        scatter.alias("scatter"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    ).withColumn("bucket", F.pmod(F.shiftright("scatter", 8), F.lit(buckets)).cast("int"))
    place = F.col("shard") * buckets + F.col("bucket")
    gathered = (
        rows.withColumn("place", place)
        .repartition(shards * buckets, "place")  # the grouping needs no exchange of its own
        .groupBy("place", "shard", "bucket")
        .agg(F.sort_array(F.collect_list(F.struct("scatter", "row"))).alias("rows"))
    )
    # A bucket is permuted whole, in one task; an attempt's rows are written all or not at all.
    shuffled = gathered.select("shard", "bucket", F.shuffle("rows", seed).alias("rows"))
    placed = shuffled.select("shard", "bucket", F.posexplode("rows").alias("position", "entry"))
    shaped = placed.select("shard", "bucket", "position", "entry.row")
    with shuffles_dropped(docs.sparkSession):
        shaped.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """(shard, slot, row) of every row written; slots of a shard run from 0 without gaps.

    ``columns`` is the schema of the rows: shards of an empty table hold no file that tells it.
    """
    layout = StructType().add("bucket", "integer").add("position", "integer").add("row", columns).add("shard", "integer")
    rows = spark.read.schema(layout).parquet(path)
    sizes = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    slot = F.col("start") + F.col("position")
    # One row a bucket, small beside the rows: these are joined where they are read, not shuffled again.
    return rows.join(F.broadcast(starts), ["shard", "bucket"]).select(
        F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), "row"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents into 16 shuffled shards in the shared folder; what those files hold."""
    path, seed, docs = scratch_path(spark, "shards"), 8, read(spark, sf_dir, "documents")
    write_shards(docs, path, SHARDS, seed)
    text = F.coalesce("row.text", F.lit(""))
    return read_shards(spark, path, docs.schema).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("row.doc_id"), SHARDS + 1, seed).alias("grown_shard"),
    )
