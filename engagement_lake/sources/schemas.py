"""Raw read schemas and the column contract of every written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Raw read schemas. Scalar leaves are text on purpose and are coerced later: a DOUBLE leaf would
# silently turn the JSON text "0.5" into NULL.
_USER_AGENT = "STRUCT<browser: STRING, browser_version: STRING, platform: STRING, mobile: STRING>"
_THUMBNAIL = "STRUCT<url: STRING, width: STRING, height: STRING>"
_VISITOR_FIELDS = (
    ("visitor_key", "STRING"),
    ("created_at", "STRING"),
    ("last_active_at", "STRING"),
    ("last_event_key", "STRING"),
    ("load_count", "STRING"),
    ("play_count", "STRING"),
    ("identifying_event_key", "STRING"),
    ("visitor_identity", "STRUCT<name: STRING, email: STRING, org: STRUCT<name: STRING, title: STRING>>"),
    ("user_agent_details", _USER_AGENT),
)
_VISITOR_DDL = ", ".join(f"{name} {kind}" for name, kind in _VISITOR_FIELDS)
_VISITOR_STRUCT = ", ".join(f"{name}: {kind}" for name, kind in _VISITOR_FIELDS)

VISITOR_FIELDS = tuple(name for name, _ in _VISITOR_FIELDS)

RAW_DDL = {
    "media_metadata": f"""
        id STRING, hashed_id STRING, type STRING, name STRING, duration STRING, created STRING,
        updated STRING, status STRING, archived STRING, description STRING,
        project STRUCT<id: STRING, hashed_id: STRING, name: STRING>, section STRING,
        share_link STRUCT<url: STRING>, thumbnail {_THUMBNAIL}""",
    "media_stats": """
        load_count STRING, play_count STRING, play_rate STRING, hours_watched STRING,
        engagement STRING, visitors STRING""",
    "visitors": f"{_VISITOR_DDL}, visitors ARRAY<STRUCT<{_VISITOR_STRUCT}>>",
    "events": f"""
        event_key STRING, received_at STRING, visitor_key STRING, media_id STRING,
        media_name STRING, media_url STRING, percent_viewed STRING, ip STRING, country STRING,
        region STRING, city STRING, lat STRING, lon STRING, org STRING, email STRING,
        embed_url STRING, conversion_type STRING, conversion_data STRING,
        iframe_heatmap_url STRING, user_agent_details {_USER_AGENT}, thumbnail {_THUMBNAIL},
        _page STRING""",
}

# The fields of each endpoint's records.
RAW_FIELDS = {
    "media_metadata": (
        "id", "hashed_id", "type", "name", "duration", "created", "updated", "status", "archived",
        "description", "project", "section", "share_link", "thumbnail",
    ),
    "media_stats": ("load_count", "play_count", "play_rate", "hours_watched", "engagement", "visitors"),
}

# Endpoint and table names, and the columns of each table in output order.
ENDPOINTS = ("media_metadata", "media_stats", "visitors", "events")
GOLD_TABLES = ("dim_media", "fact_media_daily_stats", "fact_media_engagement", "dim_visitor")
MART_TABLES = (
    "mart_channel_performance",
    "mart_geo_engagement",
    "mart_device_browser",
    "mart_visitor_engagement",
)

TABLE_DDL = {
    "media_metadata": """
        media_numeric_id BIGINT, media_hashed_id STRING, media_type STRING, media_name STRING,
        duration_seconds DOUBLE, created_at TIMESTAMP, updated_at TIMESTAMP, status STRING,
        archived BOOLEAN, description STRING, project_id BIGINT, project_hashed_id STRING,
        project_name STRING, section_id BIGINT, section_name STRING, share_url STRING,
        thumbnail_url STRING, thumbnail_width INT, thumbnail_height INT, source_file STRING,
        ingest_date STRING, source_media_id STRING, silver_processed_at TIMESTAMP""",
    "media_stats": """
        media_hashed_id STRING, load_count BIGINT, play_count BIGINT, api_play_rate DOUBLE,
        calculated_play_rate DOUBLE, hours_watched DOUBLE, engagement DOUBLE,
        visitor_count BIGINT, source_file STRING, ingest_date STRING, source_media_id STRING,
        silver_processed_at TIMESTAMP""",
    "visitors": """
        visitor_key STRING, created_at TIMESTAMP, last_active_at TIMESTAMP,
        last_event_key STRING, load_count BIGINT, play_count BIGINT,
        identifying_event_key STRING, visitor_name STRING, visitor_email STRING,
        visitor_org_name STRING, visitor_org_title STRING, browser STRING,
        browser_version STRING, platform STRING, is_mobile BOOLEAN, source_file STRING,
        ingest_date STRING, silver_processed_at TIMESTAMP""",
    "events": """
        event_key STRING, received_at TIMESTAMP, visitor_key STRING, media_hashed_id STRING,
        media_name STRING, media_url STRING, percent_viewed DOUBLE, ip_address STRING,
        country STRING, region STRING, city STRING, latitude DOUBLE, longitude DOUBLE,
        organization STRING, email STRING, embed_url STRING, conversion_type STRING,
        conversion_data_json STRING, iframe_heatmap_url STRING, browser STRING,
        browser_version STRING, platform STRING, is_mobile BOOLEAN, thumbnail_url STRING,
        thumbnail_width INT, thumbnail_height INT, source_file STRING, ingest_date STRING,
        source_media_id STRING, source_page INT, silver_processed_at TIMESTAMP""",
    "dim_media": """
        media_key STRING, media_hashed_id STRING, media_numeric_id BIGINT, channel STRING,
        media_name STRING, media_type STRING, duration_seconds DOUBLE, created_at TIMESTAMP,
        updated_at TIMESTAMP, status STRING, archived BOOLEAN, description STRING,
        project_id BIGINT, project_hashed_id STRING, project_name STRING, section_id BIGINT,
        section_name STRING, share_url STRING, thumbnail_url STRING, thumbnail_width INT,
        thumbnail_height INT, ingest_date STRING""",
    "fact_media_daily_stats": """
        media_daily_stats_key STRING, media_hashed_id STRING, channel STRING,
        snapshot_date STRING, load_count BIGINT, play_count BIGINT, api_play_rate DOUBLE,
        calculated_play_rate DOUBLE, hours_watched DOUBLE, engagement DOUBLE,
        visitor_count BIGINT, ingest_date STRING""",
    "fact_media_engagement": """
        media_engagement_key STRING, event_key STRING, received_at TIMESTAMP, event_date DATE,
        media_hashed_id STRING, channel STRING, visitor_key STRING, percent_viewed DOUBLE,
        ip_address STRING, country STRING, region STRING, city STRING, latitude DOUBLE,
        longitude DOUBLE, organization STRING, email STRING, browser STRING,
        browser_version STRING, platform STRING, is_mobile BOOLEAN, embed_url STRING,
        media_url STRING, conversion_type STRING, conversion_data_json STRING,
        iframe_heatmap_url STRING, thumbnail_url STRING, thumbnail_width INT,
        thumbnail_height INT, ingest_date STRING, source_page INT""",
    "dim_visitor": """
        visitor_key_dim STRING, visitor_key STRING, email STRING, ip_address STRING,
        country STRING, region STRING, city STRING, latitude DOUBLE, longitude DOUBLE,
        organization STRING, browser STRING, browser_version STRING, platform STRING,
        is_mobile BOOLEAN, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP,
        event_count BIGINT, avg_percent_viewed DOUBLE, max_percent_viewed DOUBLE,
        media_count BIGINT, ingest_date STRING""",
    "mart_channel_performance": """
        snapshot_date STRING, channel STRING, media_count BIGINT, media_names STRING,
        total_load_count BIGINT, total_play_count BIGINT, avg_api_play_rate DOUBLE,
        avg_calculated_play_rate DOUBLE, total_hours_watched DOUBLE, avg_engagement DOUBLE,
        total_visitor_count BIGINT, engagement_event_count BIGINT,
        unique_event_visitors BIGINT, avg_percent_viewed DOUBLE, max_percent_viewed DOUBLE,
        completed_view_count BIGINT, completion_rate DOUBLE, mobile_event_count BIGINT,
        mobile_event_rate DOUBLE""",
    "mart_geo_engagement": """
        country STRING, region STRING, city STRING, channel STRING,
        engagement_event_count BIGINT, unique_visitors BIGINT, avg_percent_viewed DOUBLE,
        max_percent_viewed DOUBLE, completed_view_count BIGINT, completion_rate DOUBLE,
        first_event_at TIMESTAMP, last_event_at TIMESTAMP""",
    "mart_device_browser": """
        platform STRING, browser STRING, browser_version STRING, is_mobile BOOLEAN,
        channel STRING, engagement_event_count BIGINT, unique_visitors BIGINT,
        avg_percent_viewed DOUBLE, max_percent_viewed DOUBLE, completed_view_count BIGINT,
        completion_rate DOUBLE, first_event_at TIMESTAMP, last_event_at TIMESTAMP""",
    "mart_visitor_engagement": """
        visitor_key STRING, email STRING, country STRING, region STRING, city STRING,
        organization STRING, browser STRING, browser_version STRING, platform STRING,
        is_mobile BOOLEAN, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP,
        event_count BIGINT, avg_percent_viewed DOUBLE, max_percent_viewed DOUBLE,
        completed_event_count BIGINT, completion_rate DOUBLE, engagement_segment STRING,
        media_count BIGINT, channels_seen STRING, media_seen STRING, ingest_date STRING""",
}


def column_types(table: str) -> dict[str, str]:
    """Column name to SQL type, in output order."""
    return dict(column.split() for column in TABLE_DDL[table].split(","))


def columns_of(table: str) -> list[str]:
    return list(column_types(table))


def arrange(df: DataFrame, table: str) -> DataFrame:
    """Project to the table's columns in contract order; a missing column is an error."""
    return df.select(*columns_of(table))


def complete(df: DataFrame, table: str) -> DataFrame:
    """Project to the table's columns; a missing column becomes a typed NULL."""
    present = set(df.columns)
    return df.select(
        *[
            F.col(name) if name in present else F.lit(None).cast(kind).alias(name)
            for name, kind in column_types(table).items()
        ]
    )


def select_existing(df: DataFrame, names: list[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*[n for n in names if n in present])
