"""Silver: raw JSON flattened, typed and, for events, one row per event key."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from engagement_lake.functions import (
    json_text,
    play_rate,
    section_parts,
    to_boolean,
    to_double,
    to_int,
    to_long,
    to_timestamp,
)
from engagement_lake.operators.dedup import keep_first
from engagement_lake.sources.raw import scan_raw_json, with_path_metadata
from engagement_lake.sources.schemas import ENDPOINTS, RAW_FIELDS, VISITOR_FIELDS, arrange
from engagement_lake.sources.session import scan_tasks, scratch_path, unsorted_folders
from engagement_lake.sources.tables import find_table, remove_path, write_table

log = logging.getLogger(__name__)

QUARANTINE = "quarantine"

# A staged file holds so many records at most, and a task reads one: what dedup sorts fits its memory.
STAGED_ROWS = 100_000


def flatten_media_metadata(raw: DataFrame) -> DataFrame:
    """One row per metadata response."""
    section_id, section_name = section_parts("section")
    flat = raw.withColumns(
        {
            "media_numeric_id": to_long("id"),
            "media_hashed_id": F.col("hashed_id"),
            "media_type": F.col("type"),
            "media_name": F.col("name"),
            "duration_seconds": to_double("duration"),
            "created_at": to_timestamp("created"),
            "updated_at": to_timestamp("updated"),
            "archived": to_boolean("archived"),
            "project_id": to_long("project.id"),
            "project_hashed_id": F.col("project.hashed_id"),
            "project_name": F.col("project.name"),
            "section_id": section_id,
            "section_name": section_name,
            "share_url": F.col("share_link.url"),
            **_thumbnail(),
        }
    )
    return arrange(flat, "media_metadata")


def flatten_media_stats(raw: DataFrame) -> DataFrame:
    """One row per statistics response; only its path says which media it is about."""
    flat = raw.withColumns(
        {
            "media_hashed_id": F.col("source_media_id"),
            "load_count": to_long("load_count"),
            "play_count": to_long("play_count"),
            "api_play_rate": to_double("play_rate"),
            "calculated_play_rate": play_rate(to_long("play_count"), to_long("load_count")),
            "hours_watched": to_double("hours_watched"),
            "engagement": to_double("engagement"),
            "visitor_count": to_long("visitors"),
        }
    )
    return arrange(flat, "media_stats")


def flatten_visitors(raw: DataFrame) -> DataFrame:
    """One row per visitor record, whether listed at the top or under ``visitors``."""
    has_record = F.coalesce(*[F.col(c).cast("string") for c in VISITOR_FIELDS]).isNotNull()
    records = raw.where(F.col("visitors").isNotNull() | has_record).select(
        "source_file",
        "ingest_date",
        "silver_processed_at",
        F.explode(F.coalesce("visitors", F.array(F.struct(*VISITOR_FIELDS)))).alias("v"),
    )
    flat = records.withColumns(
        {
            "visitor_key": F.col("v.visitor_key"),
            "created_at": to_timestamp("v.created_at"),
            "last_active_at": to_timestamp("v.last_active_at"),
            "last_event_key": F.col("v.last_event_key"),
            "load_count": to_long("v.load_count"),
            "play_count": to_long("v.play_count"),
            "identifying_event_key": F.col("v.identifying_event_key"),
            "visitor_name": F.col("v.visitor_identity.name"),
            "visitor_email": F.col("v.visitor_identity.email"),
            "visitor_org_name": F.col("v.visitor_identity.org.name"),
            "visitor_org_title": F.col("v.visitor_identity.org.title"),
            **_user_agent("v."),
        }
    )
    return arrange(flat, "visitors")


def flatten_events(raw: DataFrame) -> DataFrame:
    """One row per event record, repeats included."""
    flat = raw.withColumns(
        {
            "received_at": to_timestamp("received_at"),
            "media_hashed_id": F.col("media_id"),
            "percent_viewed": to_double("percent_viewed"),
            "ip_address": F.col("ip"),
            "latitude": to_double("lat"),
            "longitude": to_double("lon"),
            "organization": F.col("org"),
            "conversion_data_json": json_text("conversion_data"),
            "source_page": F.coalesce("source_page", to_int("_page")),
            **_user_agent(),
            **_thumbnail(),
        }
    )
    return arrange(flat, "events")


def _user_agent(record: str = "") -> dict:
    agent = f"{record}user_agent_details"
    return {
        "browser": F.col(f"{agent}.browser"),
        "browser_version": F.col(f"{agent}.browser_version"),
        "platform": F.col(f"{agent}.platform"),
        "is_mobile": to_boolean(f"{agent}.mobile"),
    }


def _thumbnail() -> dict:
    return {
        "thumbnail_url": F.col("thumbnail.url"),
        "thumbnail_width": to_int("thumbnail.width"),
        "thumbnail_height": to_int("thumbnail.height"),
    }


def dedup_events(events: DataFrame) -> DataFrame:
    """The earliest landed copy of each event; all events without a key count as one."""
    earliest = [F.asc_nulls_last(c) for c in ("ingest_date", "source_page", "source_file")]
    return keep_first(events, ["event_key"], earliest)


def malformed_event_rows(raw_events: DataFrame) -> DataFrame:
    """Files with payload elements that are no event: neither an event nor a visitor key."""
    keyless = F.col("event_key").isNull() & F.col("visitor_key").isNull()
    return raw_events.where(keyless).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("malformed_rows")
    )


FLATTEN = {
    "media_metadata": flatten_media_metadata,
    "media_stats": flatten_media_stats,
    "visitors": flatten_visitors,
    "events": flatten_events,
}


def is_malformed(endpoint: str) -> Column:
    """Whether a raw row is no record of its endpoint: nothing that its table needs was in it.

    A visitors document may hold no visitors; only text that is no JSON is malformed there.
    """
    fields = {"events": ("event_key", "visitor_key"), "visitors": (*VISITOR_FIELDS, "visitors")}.get(endpoint)
    if fields is None:
        fields = RAW_FIELDS[endpoint]
    nothing = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull()
    return nothing & F.try_parse_json("_value").isNull() if endpoint == "visitors" else nothing


@dataclass(frozen=True)
class Staged:
    """One endpoint's raw records, read once and written in two parts."""

    path: str
    good: DataFrame
    malformed: DataFrame
    good_rows: int
    malformed_rows: int


def stage_raw(spark: SparkSession, raw_base: str, endpoint: str) -> Staged | None:
    """Read the endpoint once and part records from what is none; None if nothing has been landed."""
    raw = scan_raw_json(spark, raw_base, endpoint, with_value=True)
    if raw is None:
        return None
    marked = with_path_metadata(raw).withColumn("malformed", is_malformed(endpoint))
    marked = marked.withColumn("_value", F.when(F.col("malformed"), F.col("_value")))
    counts, path = Observation(), scratch_path(spark, f"staged-{endpoint}")
    observed = marked.observe(
        counts,
        F.count_if(~F.col("malformed")).alias("good"),
        F.count_if(F.col("malformed")).alias("malformed"),
    )
    with unsorted_folders(spark), scan_tasks(spark):
        observed.write.partitionBy("malformed").option("maxRecordsPerFile", STAGED_ROWS).parquet(path)
    staged = spark.read.schema(marked.schema).parquet(path)
    return Staged(
        path,
        staged.where("NOT malformed").drop("malformed", "_value"),
        staged.where("malformed"),
        counts.get["good"],
        counts.get["malformed"],
    )


def quarantined(staged: Staged) -> DataFrame:
    """What was no record: its text and where it came from."""
    return staged.malformed.select(
        "source_file",
        "source_media_id",
        "ingest_date",
        "source_page",
        F.col("_value").alias("record_text"),
        "silver_processed_at",
    )


def run_silver(
    spark: SparkSession, raw_base: str, silver_base: str, endpoints: Iterable[str] | None = None
) -> dict[str, int]:
    """Rebuild the chosen silver tables; returns the rows written per table.

    Each endpoint is read once. What is no record goes to ``quarantine/<endpoint>`` below the silver
    folder, which is rewritten in every run, and not into the table.
    """
    chosen = list(ENDPOINTS if endpoints is None else endpoints)
    unknown = [e for e in chosen if e not in FLATTEN]
    if unknown:
        raise ValueError(f"unknown endpoints: {unknown}")
    written = {}
    for endpoint in chosen:
        staged = stage_raw(spark, raw_base, endpoint)
        if staged is None:
            log.info("%s: skipped, no folder below %s", endpoint, raw_base)
            continue
        aside = write_table(quarantined(staged), silver_base, f"{QUARANTINE}/{endpoint}")
        if aside != staged.malformed_rows:
            raise RuntimeError(f"{endpoint}: {staged.malformed_rows} malformed rows were read, {aside} written")
        table = FLATTEN[endpoint](staged.good)
        if not staged.good_rows or table.isEmpty():
            log.info("%s: skipped, no records below %s", endpoint, raw_base)
        else:
            table = dedup_events(table) if endpoint == "events" else table
            with scan_tasks(spark, -(-staged.good_rows // STAGED_ROWS)):
                written[endpoint] = write_table(table, silver_base, endpoint)
        remove_path(spark, staged.path)
    return written


def quarantine_counts(spark: SparkSession, silver_base: str) -> DataFrame:
    """(endpoint, malformed_rows, files) of every endpoint that the last runs read."""
    counts = spark.createDataFrame([], "endpoint STRING, malformed_rows BIGINT, files BIGINT")
    for endpoint in ENDPOINTS:
        rows = find_table(spark, silver_base, f"{QUARANTINE}/{endpoint}")
        if rows is not None:
            counts = counts.unionByName(
                rows.agg(
                    F.lit(endpoint).alias("endpoint"),
                    F.count(F.lit(1)).alias("malformed_rows"),
                    F.count_distinct("source_file").alias("files"),
                )
            )
    return counts
