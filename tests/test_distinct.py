import pytest
from pyspark.sql import functions as F

from engagement_lake.operators.distinct import Total, column_values, distinct_counts, rows_total

DDL = "g STRING, s STRING, n BIGINT, d DOUBLE, b BOOLEAN, t TIMESTAMP"
ROWS = [
    ("a", "x", 1, 0.0, True, None),
    ("a", "x", None, -0.0, None, None),
    ("a", None, 2, float("nan"), False, None),
    (None, "y", 2, float("nan"), False, None),
    (None, "", 2, 1.5, None, None),
    ("b", None, None, None, None, None),
]
COUNTED = {"strings": "s", "longs": "n", "doubles": "d", "flags": "b", "times": "t"}


def totals():
    return {
        "rows": rows_total(),
        "large": Total("count", F.col("n") > 1),
        "least": Total("min", F.col("d")),
        "most": Total("max", F.col("n")),
        "added": Total("sum", F.col("n")),
    }


def plainly(df, *keys):
    return df.groupBy(*keys).agg(
        *[F.count_distinct(c).alias(a) for a, c in COUNTED.items()],
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n") > 1).alias("large"),
        F.min("d").alias("least"), F.max("n").alias("most"), F.sum("n").alias("added"),
    )


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("keys", [(), ("g",), ("g", "s")])
@pytest.mark.parametrize("rows", [ROWS, []])
def test_equal_to_count_distinct(spark, keys, rows):
    df = spark.createDataFrame(rows, DDL).repartition(3)
    assert rows_of(distinct_counts(df, COUNTED, totals(), keys)) == rows_of(plainly(df, *keys))


def test_values_and_their_rows(spark):
    df = spark.createDataFrame(ROWS, DDL)
    found = {(r["column_no"], r["value"]): r["value_rows"] for r in column_values(df, ["s", "n"]).collect()}
    assert found == {(0, "x"): 2, (0, "y"): 1, (0, ""): 1, (0, None): 2, (1, "1"): 1, (1, "2"): 3, (1, None): 2}


def shuffled_bytes(spark, df):
    """Bytes that running the frame writes to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(e.totalShuffleWrite() for e in _seq(store.executorList(False)))
    _settle(spark)
    before = total()
    df.write.format("noop").mode("overwrite").save()
    _settle(spark)
    return total() - before


def _seq(scala_seq):
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def _settle(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()


def test_no_row_is_expanded_and_no_more_is_shuffled(spark):
    events = spark.range(0, 600_000, numPartitions=4).selectExpr(
        "concat('event-', id) AS event_key", "concat('visitor-', id % 40000) AS visitor_key",
        "concat('media-', id % 40) AS media_hashed_id", "concat('channel-', id % 3) AS channel",
        "timestamp_micros(id * 1000000) AS received_at",
    )
    columns = {"events": "event_key", "visitors": "visitor_key", "media": "media_hashed_id", "channels": "channel"}
    bounds = {
        "rows": rows_total(), "first": Total("min", F.col("received_at")), "last": Total("max", F.col("received_at")),
    }
    one_pass = distinct_counts(events, columns, bounds)
    expanded = events.agg(
        *[F.count_distinct(c).alias(a) for a, c in columns.items()], F.count(F.lit(1)).alias("rows"),
        F.min("received_at").alias("first"), F.max("received_at").alias("last"),
    )
    assert one_pass.collect() == expanded.collect()
    plan = one_pass._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan
    mine, theirs = shuffled_bytes(spark, one_pass), shuffled_bytes(spark, expanded)
    assert mine <= 1.25 * theirs  # both send each distinct key once a task; nearly all bytes are keys
