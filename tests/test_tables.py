import pytest
from pyspark.sql import functions as F

from engagement_lake.operators.dedup import keep_first
from engagement_lake.plans import gold, marts, reports, silver
from engagement_lake.sources.tables import (
    analyze_tables,
    footers,
    latest_rows,
    read_latest_snapshot,
    read_table,
    register_tables,
    snapshots_of,
    table_statistics,
    write_clustered,
    write_table,
)

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stats(silver):
    rows = [{"snapshot_date": d, "media_hashed_id": f"m{n}", "load_count": n} for d in DAYS for n in range(3)]
    return silver("fact_media_daily_stats", rows)


def test_a_folder_per_snapshot(spark, tmp_path, stats):
    base, name = str(tmp_path), "fact_media_daily_stats"
    assert write_table(stats, base, name, snapshots=True) == 9
    assert snapshots_of(spark, base, name) == list(DAYS)
    table = read_table(spark, base, name)
    assert table.columns == stats.columns and table.schema["snapshot_date"].dataType.simpleString() == "string"
    assert sorted(table.collect()) == sorted(stats.collect())
    # Rebuilding one snapshot leaves the others.
    again = stats.where("snapshot_date = '2024-01-02' AND media_hashed_id = 'm1'")
    assert write_table(again, base, name, snapshots=True) == 1
    assert read_table(spark, base, name).count() == 7


def test_only_the_latest_snapshot_is_read(spark, tmp_path, stats):
    base, name = str(tmp_path), "fact_media_daily_stats"
    write_table(stats, base, name, snapshots=True)
    for day in DAYS[:2]:
        for file in (tmp_path / name / f"snapshot_date={day}").glob("*.parquet"):
            file.write_bytes(b"unreadable")
        for file in (tmp_path / name / f"snapshot_date={day}").glob(".*.crc"):
            file.unlink()
    latest = read_latest_snapshot(spark, base, name)
    assert sorted(r["media_hashed_id"] for r in latest.collect()) == ["m0", "m1", "m2"]
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan_of(latest)


def test_the_latest_date_prunes_folders(spark, tmp_path, stats):
    base, name = str(tmp_path), "fact_media_daily_stats"
    write_table(stats, base, name, snapshots=True)
    latest = latest_rows(read_table(spark, base, name))
    assert "Subquery" in plan_of(latest).split("PartitionFilters: [")[1].split("]")[0]
    assert latest.count() == 3
    assert latest_rows(stats).count() == 3 and latest_rows(stats.limit(0)).count() == 0
    write_table(stats, base, "plain")
    assert read_latest_snapshot(spark, base, "plain").count() == 3


def test_rows_are_counted_from_footers(spark, tmp_path, stats):
    write_table(stats, str(tmp_path), "t")
    counted = footers(spark, str(tmp_path), "t").agg(F.count(F.lit(1)).alias("n"), F.max("load_count").alias("m"))
    assert "PushedAggregation: [COUNT(*), MAX(load_count)]" in plan_of(counted)
    assert counted.head().asDict() == {"n": 9, "m": 2}
    assert "BatchScan" not in plan_of(spark.read.parquet(str(tmp_path / "t")))  # only that table

    class Written(dict):
        def footers(self, name):
            return footers(spark, str(tmp_path), name)

    found = reports.row_counts(Written(), ("t",))
    assert [tuple(r) for r in found.collect()] == [("t", 9)] and "PushedAggregation: [COUNT(*)]" in plan_of(found)


@pytest.fixture
def clustered(spark, tmp_path, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    events = silver("events", [
        {"event_key": f"e{n % 40}", "visitor_key": f"v{n % 7}" if n % 5 else None, "media_hashed_id": f"m{n % 3}",
         "ingest_date": f"2024-01-0{n % 9 + 1}", "percent_viewed": (n % 10) / 9}
        for n in range(200)
    ])
    visitors = silver("visitors", [{"visitor_key": f"v{n % 9}", "ingest_date": f"d{n}"} for n in range(20)])
    base = str(tmp_path)
    write_clustered(events, "clustered", base, "events_by_event", "event_key", 8, ("ingest_date",))
    write_clustered(events, "clustered", base, "events_by_visitor", "visitor_key", 8)
    write_clustered(visitors, "clustered", base, "visitors", "visitor_key", 8)
    yield events, visitors, lambda name: spark.table(f"clustered.{name}")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP DATABASE clustered CASCADE")


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_clustered_events_are_deduplicated_without_a_shuffle(clustered):
    events, _, table = clustered
    found = silver.dedup_events(table("events_by_event"))
    assert "Exchange" not in plan_of(found)
    assert rows_of(found) == rows_of(silver.dedup_events(events))


def test_clustered_visitors_join_without_a_shuffle(clustered):
    events, visitors, table = clustered

    def joined(events, visitors):
        totals = events.groupBy("visitor_key").agg(F.count(F.lit(1)).alias("n"))
        return totals.join(gold.dedup_visitors(visitors), "visitor_key", "left")

    found = joined(table("events_by_visitor"), table("visitors"))
    assert "Exchange" not in plan_of(found)
    assert rows_of(found) == rows_of(joined(events, visitors))


def test_clustered_viewing_joins_without_a_shuffle(clustered):
    events, visitors, table = clustered

    def joined(events, visitors):
        fact = events.withColumn("channel", F.lit("c"))
        return visitors.join(marts.visitor_viewing(fact), "visitor_key", "left")

    found = joined(table("events_by_visitor"), table("visitors"))
    assert "Exchange" not in plan_of(found)
    assert rows_of(found) == rows_of(joined(events, visitors))


def test_statistics_reach_the_plan(spark, tmp_path, stats):
    base = str(tmp_path)
    write_table(stats, base, "fact")
    register_tables(spark, "analysed", base, ["fact"])
    assert {r["row_count"] for r in table_statistics(spark, "analysed").collect()} == {None}
    analyze_tables(spark, "analysed", ["fact"])
    found = {r["column_name"]: r for r in table_statistics(spark, "analysed").collect()}
    assert (found["load_count"]["row_count"], found["load_count"]["min"], found["load_count"]["max"]) == (9, "0", "2")
    assert found["channel"]["null_count"] == 9 and found["media_hashed_id"]["distinct_count"] == 3
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        table = spark.table("analysed.fact").where("load_count = 1")
        estimate = table._jdf.queryExecution().optimizedPlan().stats().rowCount().get()
        assert int(str(estimate)) == 3
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
        spark.sql("DROP DATABASE analysed CASCADE")
