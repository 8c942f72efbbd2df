"""Joins with a table too large to broadcast, where some keys have a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy from one HEAVY-th of the rows on: there are at most HEAVY of them.
HEAVY = 1000
# A salt of a heavy key gets about one SALTS-th of all rows.
SALTS = 200


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, salts) of the keys with at least one ``HEAVY``-th of the rows, by their share.

    One scan of the key column, counted in the map tasks; at most ``HEAVY`` rows.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(total), F.col("n") * HEAVY >= F.col("total"))
    salts = F.ceil(F.col("n") * SALTS / F.col("total")).cast("int")
    return shares.select(key, F.greatest(salts, F.lit(1)).alias("salts"))


def spread_left_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``df`` left-joined with ``other``, which holds each key once, by a shuffle without hot tasks.

    Rows of heavy keys are dealt over salts, and the other side's rows of these keys are repeated for
    each. Rows without a key match nothing and are dealt over all salts.
    """
    heavy = F.broadcast(heavy_keys(df, key))
    place = F.monotonically_increasing_id()
    dealt = df.join(heavy, key, "left")
    salts = F.when(F.col(key).isNull(), F.lit(SALTS)).otherwise(F.coalesce("salts", F.lit(1)))
    dealt = dealt.withColumn("_salt", F.pmod(place, salts).cast("int")).drop("salts")
    repeated = other.where(F.col(key).isNotNull()).join(heavy, key, "left")
    last = F.coalesce("salts", F.lit(1)) - 1
    repeated = repeated.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("salts")
    names = [c for c in other.columns if c != key]
    # The hint keeps the join a shuffle by (key, salt): a sort-merge join or, if a side is small, a broadcast.
    return dealt.join(repeated, [key, "_salt"], "left").select(*df.columns, *names)
