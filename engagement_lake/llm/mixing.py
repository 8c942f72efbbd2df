"""Mixing sources to target weights by weighted fair queueing, in built-in functions only.

Every source's documents queue in a seeded shuffled order, the whole queue a second time after the
first. A document's virtual finish time is the number of words its source has sent when it ends,
divided by the source's target. All sources' documents in order of finish time, cut where the total
budget is used up, are the mix: a source reaches its target as every other does, at time 1.

Running sums over a source or over all documents are taken in two steps, within buckets of bounded
size and over one row per bucket, so that no task holds a source. The cut is one finish time, found
in the one bucket of finish times in which the budget runs out.

Cases: a null text has no words and is never taken; the null source is a source and comes last;
sources of no words get no target. Documents that are equal in all columns are interchangeable.
An empty table gives no rows. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from engagement_lake.llm.store import read, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2
BUCKET_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"

_RANGE_BEFORE = (Window.unboundedPreceding, -1)
_RANGE_AFTER = (Window.currentRow, Window.unboundedFollowing)
_RANGE_TO = (Window.unboundedPreceding, Window.currentRow)


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most_times=MOST_TIMES) -> DataFrame:
    """(source, source_rank, source_size, target) of (source, size) rows.

    Sources by code point, null last, have the weights in turn. A target is its weight's part of
    ``share`` times all sizes, or ``most_times`` its source's size if that is less; the excess is
    shared again by weight. With sources in order of (limit / weight), those before one at their
    limit leave it and the rest a level per weight; the highest such level is the one that holds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("source_rank", F.row_number().over(by_name) - 1)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.get(turn, F.col("source_rank") % len(weights)))
    sources = sources.withColumn("limit", F.col("source_size") * float(most_times))

    fill = Window.orderBy(F.col("limit") / F.col("weight"), "source_rank")
    everything = Window.partitionBy()
    leveled = sources.select(
        "*",
        F.coalesce(F.sum("limit").over(fill.rowsBetween(*_RANGE_BEFORE)), F.lit(0.0)).alias("used"),
        F.sum("weight").over(fill.rowsBetween(*_RANGE_AFTER)).alias("weight_left"),
        (F.sum("source_size").over(everything) * float(share)).alias("budget"),
    )
    level = (F.col("budget") - F.col("used")) / F.col("weight_left")
    leveled = leveled.withColumn("level", F.max(level).over(everything))
    target = F.least("limit", F.col("level") * F.col("weight"))
    return leveled.select("source", "source_rank", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most_times: int = MOST_TIMES,
    seed: int = 4,
) -> DataFrame:
    """(row, size, source_size, target, copies, finish): how often the mix takes each document.

    ``row`` holds all columns of ``docs``; ``finish`` is the virtual finish time of the first copy,
    null in a source without a target.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.col(source).alias("source"),
        size.alias("size"),
        F.xxhash64(*columns, F.lit(seed)).alias("draw"),
        F.struct(*columns).alias("row"),
    )
    # The sums need no whole rows: sizes are measured once for all of them.
    sizes = written(rows.drop("row"), "sizes")
    targets = source_targets(sizes.select("source", "size"), weights, share, most_times)
    buckets = max(16, -(-sizes.count() // BUCKET_ROWS))
    bucket = F.pmod(F.shiftright("draw", 8), F.lit(buckets))
    sizes, rows = sizes.withColumn("bucket", bucket), rows.withColumn("bucket", bucket)

    # Where each bucket of a source begins in its queue, with what is known of the source.
    sums = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(*_RANGE_BEFORE)
    starts = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)))
    starts = written(_join_source(starts.drop("bucket_size"), targets, []), "starts")

    last = _last_paid(_queued(sizes, starts, most_times), share, most_times, buckets)
    queued = _queued(rows, starts, most_times)
    copies = F.lit(0)
    for finish_time in [F.col(f"finish_{t}") for t in range(most_times)] if last else []:
        same_time = (finish_time == last["finish"]) & (F.col("source_rank") <= last["source_rank"])
        paid = (F.col("size") > 0) & ((finish_time < last["finish"]) | same_time)
        copies += F.when(paid, 1).otherwise(0)
    return queued.select(
        "row",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        F.col("finish_0").alias("finish"),
    )


def _queued(rows: DataFrame, starts: DataFrame, most_times: int) -> DataFrame:
    """The rows with ``finish_0``, ``finish_1``, ...: the virtual finish time of each copy.

    The order in a bucket is total but for rows equal in all columns, so every call agrees.
    """
    in_bucket = Window.partitionBy("source", "bucket").orderBy("draw", "size")
    sent = F.sum("size").over(in_bucket.rowsBetween(*_RANGE_TO))
    queued = _join_source(rows.withColumn("sent", sent), starts, ["bucket"])
    sent = F.col("start") + F.col("sent")
    finish = [
        ((sent + F.col("source_size") * turn) / F.nullif("target", F.lit(0.0))) for turn in range(most_times)
    ]
    return queued.withColumns({f"finish_{turn}": f for turn, f in enumerate(finish)})


def _join_source(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on the source, null being a source, and further keys."""
    other = right.select(
        F.col("source").alias("other"), *[F.col(k).alias(f"other_{k}") for k in keys],
        *[c for c in right.columns if c not in ("source", *keys)],
    )
    on = left["source"].eqNullSafe(other["other"])
    for k in keys:
        on &= left[k] == other[f"other_{k}"]
    return left.join(other, on).drop("other", *[f"other_{k}" for k in keys])


def _last_paid(queued: DataFrame, share: float, most_times: int, buckets: int) -> Row | None:
    """(finish, source_rank) of the last document that the budget pays for; None without words."""
    turns = F.array(*[F.col(f"finish_{t}") for t in range(most_times)])
    sends = queued.where("size > 0").select("size", "source_rank", F.explode(turns).alias("finish"))
    sends = sends.where("finish IS NOT NULL").withColumn("bin", F.floor(F.col("finish") * buckets))
    bins = sends.groupBy("bin").agg(F.sum("size").alias("bin_size"))
    in_order = Window.orderBy("bin").rowsBetween(*_RANGE_BEFORE)
    total = F.sum("bin_size").over(Window.partitionBy()) / F.lit(float(most_times))
    bins = bins.select(
        "bin",
        F.coalesce(F.sum("bin_size").over(in_order), F.lit(0)).alias("bin_start"),
        (total * share).alias("budget"),
    )
    crossed = bins.where("bin_start <= budget").orderBy(F.desc("bin")).head()
    if crossed is None:
        return None
    # All bins before are paid for in full; in this one the budget may run out.
    order = Window.partitionBy("bin").orderBy("finish", "source_rank").rowsBetween(*_RANGE_TO)
    used = F.lit(crossed["bin_start"]) + F.sum("size").over(order)
    paid = sends.where(F.col("bin") == crossed["bin"]).withColumn("used", used)
    last = paid.where(F.col("used") <= crossed["budget"]).orderBy(F.desc("used")).head()
    return last or Row(finish=crossed["bin"] / buckets, source_rank=-1)


def mixed_documents(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it was taken, in order of finish time."""
    lap = F.col("source_size") / F.col("target")
    turns = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("turn")
    copies = mixed.where("copies > 0").select("row", "finish", lap.alias("lap"), turns)
    copies = copies.withColumn("time", F.col("finish") + F.col("turn") * F.col("lap"))
    return copies.repartitionByRange("time").sortWithinPartitions("time").select("row.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    narrow = written(docs.select("doc_id", "source", n_words("text").alias("n_words")), "word_counts")
    mixed = mix_sources(narrow, F.col("n_words"))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )
