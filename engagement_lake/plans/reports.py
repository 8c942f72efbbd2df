"""Smoke checks and business reports over gold and mart tables.

Each report takes its tables by name and returns a frame. Orders sort NULLs last, and every
limited report breaks ties by its group keys, so its rows are the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.operators.aggregates import Mean
from engagement_lake.operators.distinct import Total, distinct_counts, rows_total
from engagement_lake.sources.schemas import GOLD_TABLES, MART_TABLES
from engagement_lake.sources.tables import footers, latest_rows, read_latest_snapshot, read_table

Tables = Mapping[str, DataFrame]

# The columns of the reports, in output order.
DAILY_STATS_COLUMNS = (
    "snapshot_date",
    "channel",
    "media_hashed_id",
    "load_count",
    "play_count",
    "api_play_rate",
    "calculated_play_rate",
    "hours_watched",
    "engagement",
    "visitor_count",
)
CHANNEL_COLUMNS = (
    "snapshot_date",
    "channel",
    "media_count",
    "total_load_count",
    "total_play_count",
    "avg_api_play_rate",
    "total_hours_watched",
    "avg_engagement",
    "engagement_event_count",
    "unique_event_visitors",
    "avg_percent_viewed",
    "completed_view_count",
    "completion_rate",
    "mobile_event_rate",
)
MEDIA_COLUMNS = (
    "media_hashed_id",
    "channel",
    "media_name",
    "duration_seconds",
    "status",
    "ingest_date",
)
GEO_KEYS = ("country", "region", "city", "channel")
DEVICE_KEYS = ("platform", "browser", "browser_version", "is_mobile", "channel")
VIEW_COLUMNS = (
    "engagement_event_count",
    "unique_visitors",
    "avg_percent_viewed",
    "completed_view_count",
    "completion_rate",
)
VISITOR_COLUMNS = (
    "visitor_key",
    "country",
    "region",
    "city",
    "platform",
    "browser",
    "event_count",
    "avg_percent_viewed",
    "max_percent_viewed",
    "completed_event_count",
    "completion_rate",
    "channels_seen",
    "media_seen",
)
# Null count columns of the event fact, and the columns they count.
NULL_COUNTS = {
    "null_event_keys": "event_key",
    "null_media_ids": "media_hashed_id",
    "null_channels": "channel",
    "null_visitor_keys": "visitor_key",
    "null_percent_viewed": "percent_viewed",
}


def ascending(*names: str) -> list[Column]:
    return [F.asc_nulls_last(n) for n in names]


def top(df: DataFrame, n: int, by: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The n rows with the highest ``by`` values; equal ones in the order of their keys."""
    return df.orderBy(*[F.desc_nulls_last(b) for b in by], *ascending(*keys)).limit(n)


def row_counts(tables: Tables, names: tuple[str, ...]) -> DataFrame:
    """Counts by table. Tables that offer their ``footers`` are counted without reading a row."""
    source = getattr(tables, "footers", tables.__getitem__)
    counts = [
        source(name)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def latest_snapshot(tables: Tables, name: str) -> DataFrame:
    """Rows of the table's newest snapshot; written tables read only its folder, if it has one."""
    read = getattr(tables, "latest", None)
    return read(name) if read else latest_rows(tables[name])


def rows_by_snapshot(df: DataFrame, counted: str, alias: str) -> DataFrame:
    return (
        df.groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(counted).alias(alias))
        .orderBy(*ascending("snapshot_date"))
    )


def gold_row_counts(t: Tables) -> DataFrame:
    return row_counts(t, GOLD_TABLES)


def mart_row_counts(t: Tables) -> DataFrame:
    return row_counts(t, MART_TABLES)


def mart_rows_by_snapshot(t: Tables) -> DataFrame:
    return rows_by_snapshot(t["mart_channel_performance"], "channel", "channel_count")


def latest_snapshot_count(t: Tables) -> DataFrame:
    latest = latest_snapshot(t, "mart_channel_performance")
    return row_counts({"mart_channel_performance_latest": latest}, ("mart_channel_performance_latest",))


def latest_channel_performance(t: Tables) -> DataFrame:
    latest = latest_snapshot(t, "mart_channel_performance")
    return latest.select(*CHANNEL_COLUMNS).orderBy(*ascending("channel"))


def media_channel_mapping(t: Tables) -> DataFrame:
    return t["dim_media"].select(*MEDIA_COLUMNS).orderBy(*ascending("channel"))


def duplicate_event_keys(t: Tables) -> DataFrame:
    counts = t["fact_media_engagement"].agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("event_key").alias("distinct_event_keys"),
    )
    return counts.withColumn(
        "duplicate_event_key_count", F.col("total_rows") - F.col("distinct_event_keys")
    )


def missing_critical_keys(t: Tables) -> DataFrame:
    return t["fact_media_engagement"].agg(
        *[F.sum(F.col(c).isNull().cast("int")).alias(a) for a, c in NULL_COUNTS.items()]
    )


def channel_distribution(t: Tables, mean: Mean = F.avg) -> DataFrame:
    return (
        t["fact_media_engagement"]
        .groupBy("channel", "media_hashed_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("visitor_key").alias("unique_visitors"),
            mean(F.col("percent_viewed")).alias("avg_percent_viewed"),
            F.max("percent_viewed").alias("max_percent_viewed"),
        )
        .orderBy(*ascending("channel"))
    )


def daily_stats_listing(t: Tables) -> DataFrame:
    facts = t["fact_media_daily_stats"]
    return facts.select(*DAILY_STATS_COLUMNS).orderBy(*ascending("channel"))


def channel_comparison(t: Tables) -> DataFrame:
    mart = t["mart_channel_performance"]
    return mart.select(*CHANNEL_COLUMNS).orderBy(*ascending("channel"))


def top_geographies(t: Tables) -> DataFrame:
    mart = t["mart_geo_engagement"].select(*GEO_KEYS, *VIEW_COLUMNS)
    return top(mart, 20, ["engagement_event_count", "unique_visitors"], GEO_KEYS)


def device_breakdown(t: Tables) -> DataFrame:
    mart = t["mart_device_browser"].select(*DEVICE_KEYS, *VIEW_COLUMNS)
    return top(mart, 20, ["engagement_event_count"], DEVICE_KEYS)


def engagement_segments(t: Tables, mean: Mean = F.avg) -> DataFrame:
    return (
        t["mart_visitor_engagement"]
        .groupBy("engagement_segment")
        .agg(
            F.count(F.lit(1)).alias("visitor_count"),
            F.avg("event_count").alias("avg_events_per_visitor"),
            mean(F.col("avg_percent_viewed")).alias("avg_percent_viewed"),
            mean(F.col("completion_rate")).alias("avg_completion_rate"),
        )
        .orderBy(*ascending("engagement_segment"))
    )


def most_engaged_visitors(t: Tables) -> DataFrame:
    mart = t["mart_visitor_engagement"].select(*VISITOR_COLUMNS)
    return top(mart, 25, ["avg_percent_viewed", "event_count"], ("visitor_key",))


def event_fact_validation(t: Tables) -> DataFrame:
    measured = distinct_counts(
        t["fact_media_engagement"],
        {
            "unique_events": "event_key",
            "unique_visitors": "visitor_key",
            "media_count": "media_hashed_id",
            "channel_count": "channel",
        },
        {
            "total_events": rows_total(),
            "first_event_at": Total("min", F.col("received_at")),
            "last_event_at": Total("max", F.col("received_at")),
        },
    )
    return measured.select(
        F.lit("Gold event fact validation").alias("check_name"),
        "total_events",
        "unique_events",
        "unique_visitors",
        "media_count",
        "channel_count",
        "first_event_at",
        "last_event_at",
    )


def daily_stats_history(t: Tables) -> DataFrame:
    shown = [c for c in DAILY_STATS_COLUMNS if c != "calculated_play_rate"]
    facts = t["fact_media_daily_stats"].select(*shown)
    return facts.orderBy(*ascending("snapshot_date", "channel"))


def stats_rows_by_snapshot(t: Tables) -> DataFrame:
    return rows_by_snapshot(t["fact_media_daily_stats"], "media_hashed_id", "media_count")


def channel_history(t: Tables) -> DataFrame:
    mart = t["mart_channel_performance"]
    return mart.select(*CHANNEL_COLUMNS).orderBy(*ascending("snapshot_date", "channel"))


REPORTS: dict[str, Callable[..., DataFrame]] = {
    report.__name__: report
    for report in (
        gold_row_counts,
        mart_row_counts,
        mart_rows_by_snapshot,
        latest_snapshot_count,
        latest_channel_performance,
        media_channel_mapping,
        duplicate_event_keys,
        missing_critical_keys,
        channel_distribution,
        daily_stats_listing,
        channel_comparison,
        top_geographies,
        device_breakdown,
        engagement_segments,
        most_engaged_visitors,
        event_fact_validation,
        daily_stats_history,
        stats_rows_by_snapshot,
        channel_history,
    )
}


class LakeTables(Mapping):
    """Gold and mart tables by name, each read only when a report asks for it."""

    def __init__(self, spark: SparkSession, gold_base: str, mart_base: str):
        self._spark = spark
        self._bases = {
            **dict.fromkeys(GOLD_TABLES, gold_base),
            **dict.fromkeys(MART_TABLES, mart_base),
        }

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self._spark, self._bases[name], name)

    def footers(self, name: str) -> DataFrame:
        return footers(self._spark, self._bases[name], name)

    def latest(self, name: str) -> DataFrame:
        return read_latest_snapshot(self._spark, self._bases[name], name)

    def __iter__(self):
        return iter(self._bases)

    def __len__(self) -> int:
        return len(self._bases)


def run_report(spark: SparkSession, gold_base: str, mart_base: str, name: str) -> DataFrame:
    return REPORTS[name](LakeTables(spark, gold_base, mart_base))
