import pytest
from pyspark.sql import functions as F

from engagement_lake.operators.lists import text_segments, whole_texts
from engagement_lake.operators.skew import heavy_keys, spread_left_join


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def events_of(spark, n=60_000):
    media = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('m', id % 5000) END"
    return spark.range(0, n, numPartitions=6).selectExpr("id", f"{media} AS media_hashed_id")


def config_of(spark):
    rows = spark.range(4000).selectExpr("concat('m', id) AS media_hashed_id", "concat('c', id % 7) AS channel")
    more = [("hot", "YouTube"), (None, "none")]
    return rows.unionByName(spark.createDataFrame(more, "media_hashed_id STRING, channel STRING"))


def test_heavy_keys_are_few_and_salted_by_share(spark):
    found = {r["media_hashed_id"]: r["salts"] for r in heavy_keys(events_of(spark), "media_hashed_id").collect()}
    assert set(found) == {"hot"} and 60 <= found["hot"] <= 80
    assert heavy_keys(events_of(spark, 0), "media_hashed_id").collect() == []


def test_a_hot_media_is_spread_over_the_tasks(spark, no_broadcast):
    events, config = events_of(spark), config_of(spark)
    joined = spread_left_join(events, config, "media_hashed_id")
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert len(sizes) == 16 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    plain = events.join(config, "media_hashed_id", "left").select("id", "media_hashed_id", "channel")
    hot = [r["n"] for r in plain.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(hot) > 2 * sorted(hot)[len(hot) // 2]
    assert joined.columns == ["id", "media_hashed_id", "channel"]
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_spread_join_of_nothing(spark, no_broadcast):
    joined = spread_left_join(events_of(spark, 0), config_of(spark), "media_hashed_id")
    assert joined.collect() == []


def test_segments_put_together_are_the_list(spark):
    rows = [("a", "x"), ("a", "b"), ("a", "x"), ("a", None), (None, "é"), (None, "d"), ("empty", None)]
    rows += [("long", f"value {n:05d}") for n in range(3000)]
    df = spark.createDataFrame(rows, "k STRING, v STRING")
    segments = text_segments(df, ["k"], "v", segment_bytes=200, tasks=5)
    parts = {}
    for r in sorted(segments.collect(), key=lambda r: (str(r["k"]), r["part"])):
        parts.setdefault(r["k"], []).append((r["part"], r["text"]))
    assert all([p for p, _ in found] == list(range(len(found))) for found in parts.values())
    expected = {}
    for k, v in set(rows):
        if v is not None:
            expected.setdefault(k, []).append(v)
    assert {k: " | ".join(t for _, t in found) for k, found in parts.items()} == {
        k: " | ".join(sorted(vs)) for k, vs in expected.items()
    }
    assert max(len(t) for _, t in parts["long"]) < 230 and len(parts["long"]) > 100
    assert {r["k"]: r["text"] for r in whole_texts(segments, ["k"]).collect()} == {
        k: " | ".join(sorted(vs)) for k, vs in expected.items()
    }


def test_a_huge_group_does_not_meet_in_one_task(spark, no_broadcast):
    df = spark.range(0, 400_000, numPartitions=8).selectExpr("'all' AS k", "concat('v', id) AS v")
    segments = text_segments(df, ["k"], "v", segment_bytes=4096, tasks=16)
    sizes = [r["n"] for r in segments.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4
    assert segments.agg(F.sum(F.size(F.split("text", r" \| ")))).head()[0] == 400_000
