"""Marts: channel, geography, device and visitor aggregates over gold."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.functions import completed, distinct_text, engagement_segment, safe_divide
from engagement_lake.operators.aggregates import (
    Mean,
    first_last_event,
    share_of_events,
    view_measures,
)
from engagement_lake.operators.lists import SEGMENT_BYTES, text_segments
from engagement_lake.sources.schemas import MART_TABLES, arrange
from engagement_lake.sources.tables import read_table, write_table


def stats_by_snapshot_and_channel(daily_stats: DataFrame) -> DataFrame:
    return daily_stats.groupBy("snapshot_date", "channel").agg(
        F.count_distinct("media_hashed_id").alias("media_count"),
        F.sum("load_count").alias("total_load_count"),
        F.sum("play_count").alias("total_play_count"),
        F.avg("api_play_rate").alias("avg_api_play_rate"),
        F.avg("calculated_play_rate").alias("avg_calculated_play_rate"),
        F.sum("hours_watched").alias("total_hours_watched"),
        F.avg("engagement").alias("avg_engagement"),
        F.sum("visitor_count").alias("total_visitor_count"),
    )


def engagement_by_channel(engagement: DataFrame, mean: Mean = F.avg) -> DataFrame:
    totals = engagement.groupBy("channel").agg(
        *view_measures("unique_event_visitors", mean),
        F.count_if(F.col("is_mobile")).alias("mobile_event_count"),
    )
    return totals.withColumns(
        {
            "completion_rate": share_of_events("completed_view_count"),
            "mobile_event_rate": share_of_events("mobile_event_count"),
        }
    )


def media_names_by_channel(media: DataFrame) -> DataFrame:
    return media.groupBy("channel").agg(distinct_text("media_name").alias("media_names"))


def media_name_segments(media: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(channel, part, text): the names of ``media_names_by_channel`` for channels of very many media, whose
    list should not be one cell. A channel without names has no rows."""
    return text_segments(media, ["channel"], "media_name", segment_bytes)


def seen_segments(engagement: DataFrame, seen: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(visitor_key, part, text): the channels or media (``seen``) of ``visitor_viewing`` in segments."""
    known = engagement.where(F.col("visitor_key").isNotNull())
    return text_segments(known, ["visitor_key"], seen, segment_bytes)


def build_mart_channel_performance(
    daily_stats: DataFrame, engagement: DataFrame, media: DataFrame, mean: Mean = F.avg
) -> DataFrame:
    """One row per snapshot date and channel.

    Engagement has no snapshot: every snapshot of a channel carries the channel's engagement of
    all time, so reports look at one snapshot and never add snapshots up. Configured channels
    only: a NULL channel keeps its statistics and joins no engagement.
    """
    combined = (
        stats_by_snapshot_and_channel(daily_stats)
        .join(engagement_by_channel(engagement, mean), "channel", "left")
        .join(media_names_by_channel(media), "channel", "left")
    )
    return arrange(combined, "mart_channel_performance")


def _events_mart(engagement: DataFrame, table: str, grain: tuple[str, ...], mean: Mean) -> DataFrame:
    totals = engagement.groupBy(*grain).agg(
        *view_measures("unique_visitors", mean), *first_last_event()
    )
    return arrange(
        totals.withColumn("completion_rate", share_of_events("completed_view_count")), table
    )


def build_mart_geo_engagement(engagement: DataFrame, mean: Mean = F.avg) -> DataFrame:
    """One row per country, region, city and channel; NULL is a value of its own."""
    grain = ("country", "region", "city", "channel")
    return _events_mart(engagement, "mart_geo_engagement", grain, mean)


def build_mart_device_browser(engagement: DataFrame, mean: Mean = F.avg) -> DataFrame:
    """One row per platform, browser, version, mobile flag and channel."""
    grain = ("platform", "browser", "browser_version", "is_mobile", "channel")
    return _events_mart(engagement, "mart_device_browser", grain, mean)


def visitor_viewing(engagement: DataFrame) -> DataFrame:
    """Per visitor: channels and media seen, completed events.

    First per visitor and media: that aggregate runs on fixed-width buffers, spreads a busy
    visitor over many tasks and leaves the lists one row per media to collect. Events without a
    visitor join no visitor, so they are left out before the shuffle.
    """
    per_media = (
        engagement.where(F.col("visitor_key").isNotNull())
        .groupBy("visitor_key", "media_hashed_id", "channel")
        .agg(F.count_if(completed()).alias("completed"))
    )
    return per_media.groupBy("visitor_key").agg(
        distinct_text("channel").alias("channels_seen"),
        distinct_text("media_hashed_id").alias("media_seen"),
        F.sum("completed").alias("completed_event_count"),
    )


def build_mart_visitor_engagement(visitors: DataFrame, engagement: DataFrame) -> DataFrame:
    """One row per visitor of the visitor dimension."""
    viewed = visitors.join(visitor_viewing(engagement), "visitor_key", "left").withColumn(
        "completed_event_count", F.coalesce("completed_event_count", F.lit(0))
    )
    rated = viewed.withColumns(
        {
            "completion_rate": safe_divide(F.col("completed_event_count"), F.col("event_count")),
            "engagement_segment": engagement_segment(F.col("avg_percent_viewed")),
        }
    )
    return arrange(rated, "mart_visitor_engagement")


def run_marts(
    spark: SparkSession,
    gold_base: str,
    mart_base: str,
    marts: Iterable[str] | None = None,
    snapshots: bool = False,
) -> dict[str, int]:
    """Rebuild the chosen marts; returns the rows written per mart.

    With ``snapshots``, the channel mart has a folder per snapshot date.
    """
    chosen = list(MART_TABLES if marts is None else marts)
    unknown = [m for m in chosen if m not in MART_TABLES]
    if unknown:
        raise ValueError(f"unknown marts: {unknown}")

    def gold(name: str) -> DataFrame:
        return read_table(spark, gold_base, name)

    builders = {
        "mart_channel_performance": lambda: build_mart_channel_performance(
            gold("fact_media_daily_stats"), gold("fact_media_engagement"), gold("dim_media")
        ),
        "mart_geo_engagement": lambda: build_mart_geo_engagement(gold("fact_media_engagement")),
        "mart_device_browser": lambda: build_mart_device_browser(gold("fact_media_engagement")),
        "mart_visitor_engagement": lambda: build_mart_visitor_engagement(
            gold("dim_visitor"), gold("fact_media_engagement")
        ),
    }
    return {
        name: write_table(
            builders[name](), mart_base, name, snapshots=snapshots and name == "mart_channel_performance"
        )
        for name in chosen
    }
