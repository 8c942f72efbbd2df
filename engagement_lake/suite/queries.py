"""Every registered query, each next to the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engagement_lake.functions import (
    completed,
    distinct_text,
    engagement_segment,
    json_text,
    play_rate,
    safe_divide,
    section_parts,
    to_boolean,
    to_double,
    to_int,
    to_long,
    to_timestamp,
)
from engagement_lake.functions.names import snake_case_columns
from engagement_lake.operators.aggregates import LatestValues
from engagement_lake.operators.dedup import keep_first
from engagement_lake.operators.distinct import Total, distinct_counts, rows_total
from engagement_lake.operators.lists import text_segments, whole_texts
from engagement_lake.operators.skew import spread_left_join
from engagement_lake.operators.sorts import with_positions
from engagement_lake.plans import gold, lakehouse, marts, quality, reports, silver
from engagement_lake.sources import schemas
from engagement_lake.sources.config import load_media_config
from engagement_lake.sources.raw import land_raw_json, today, with_path_metadata
from engagement_lake.sources.raw import scan_raw_json as scan_raw
from engagement_lake.sources.session import require_utc, scratch_path
from engagement_lake.sources.tables import (
    analyze_tables,
    describe_tables,
    find_table,
    footers,
    read_table,
    register_tables,
    table_path,
    table_statistics,
    write_clustered,
    write_table,
)
from engagement_lake.suite import adapters
from engagement_lake.suite.adapters import CHANNELS, exact_mean, fixed_point_mean
from engagement_lake.suite.lake import Lake
from engagement_lake.suite.oracle import contents, mean4, mean9, over_tables, rate, row_text, text_list

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None, name: str | None = None, every_media: bool = False):
    """Register a function of a Lake, and the SELECT over the oracle's tables that checks it."""

    def register(build: Callable[[Lake], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: build(Lake(spark, folder))
        if sql is not None:
            ORACLES[key] = over_tables(sql, every_media)
        return build

    return register


# --- gold, marts ---------------------------------------------------------------------------

for _table in (*schemas.GOLD_TABLES, *schemas.MART_TABLES):
    query(f"SELECT {', '.join(schemas.columns_of(_table))} FROM {_table}", _table)(
        lambda lake, table=_table: lake[table]
    )


# --- reports -------------------------------------------------------------------------------

def _counts(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names
    )


_LATEST = """(SELECT * FROM mart_channel_performance
  WHERE snapshot_date = (SELECT max(snapshot_date) FROM mart_channel_performance))"""
_CHANNEL = ", ".join(reports.CHANNEL_COLUMNS)
_DAILY = ", ".join(reports.DAILY_STATS_COLUMNS)
_VIEWS = ", ".join(reports.VIEW_COLUMNS)

_REPORT_SQL = {
    "gold_row_counts": _counts(schemas.GOLD_TABLES),
    "mart_row_counts": _counts(schemas.MART_TABLES),
    "mart_rows_by_snapshot": """SELECT snapshot_date, count(*) AS row_count,
        count(DISTINCT channel) AS channel_count
        FROM mart_channel_performance GROUP BY snapshot_date""",
    "latest_snapshot_count": f"""SELECT 'mart_channel_performance_latest' AS table_name,
        count(*) AS row_count FROM {_LATEST}""",
    "latest_channel_performance": f"SELECT {_CHANNEL} FROM {_LATEST}",
    "media_channel_mapping": f"SELECT {', '.join(reports.MEDIA_COLUMNS)} FROM dim_media",
    "duplicate_event_keys": """SELECT count(*) AS total_rows,
        count(DISTINCT event_key) AS distinct_event_keys,
        count(*) - count(DISTINCT event_key) AS duplicate_event_key_count
        FROM fact_media_engagement""",
    "missing_critical_keys": "SELECT " + ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {a}"
        for a, c in reports.NULL_COUNTS.items()
    ) + " FROM fact_media_engagement",
    "channel_distribution": f"""SELECT channel, media_hashed_id, count(*) AS event_count,
        count(DISTINCT visitor_key) AS unique_visitors,
        {mean4('percent_viewed')} AS avg_percent_viewed,
        max(percent_viewed) AS max_percent_viewed
        FROM fact_media_engagement GROUP BY channel, media_hashed_id""",
    "daily_stats_listing": f"SELECT {_DAILY} FROM fact_media_daily_stats",
    "channel_comparison": f"SELECT {_CHANNEL} FROM mart_channel_performance",
    "top_geographies": f"""SELECT {', '.join(reports.GEO_KEYS)}, {_VIEWS}
        FROM mart_geo_engagement
        ORDER BY engagement_event_count DESC, unique_visitors DESC,
          {', '.join(f'{k} ASC NULLS LAST' for k in reports.GEO_KEYS)} LIMIT 20""",
    "device_breakdown": f"""SELECT {', '.join(reports.DEVICE_KEYS)}, {_VIEWS}
        FROM mart_device_browser
        ORDER BY engagement_event_count DESC,
          {', '.join(f'{k} ASC NULLS LAST' for k in reports.DEVICE_KEYS)} LIMIT 20""",
    "engagement_segments": f"""SELECT engagement_segment, count(*) AS visitor_count,
        avg(event_count) AS avg_events_per_visitor,
        {mean9('avg_percent_viewed')} AS avg_percent_viewed,
        {mean9('completion_rate')} AS avg_completion_rate
        FROM mart_visitor_engagement GROUP BY engagement_segment""",
    "most_engaged_visitors": f"""SELECT {', '.join(reports.VISITOR_COLUMNS)}
        FROM mart_visitor_engagement
        ORDER BY avg_percent_viewed DESC NULLS LAST, event_count DESC, visitor_key LIMIT 25""",
    "event_fact_validation": """SELECT 'Gold event fact validation' AS check_name,
        count(*) AS total_events, count(DISTINCT event_key) AS unique_events,
        count(DISTINCT visitor_key) AS unique_visitors,
        count(DISTINCT media_hashed_id) AS media_count,
        count(DISTINCT channel) AS channel_count,
        min(received_at) AS first_event_at, max(received_at) AS last_event_at
        FROM fact_media_engagement""",
    "daily_stats_history": f"""SELECT {_DAILY.replace('calculated_play_rate, ', '')}
        FROM fact_media_daily_stats""",
    "stats_rows_by_snapshot": """SELECT snapshot_date, count(*) AS row_count,
        count(DISTINCT media_hashed_id) AS media_count
        FROM fact_media_daily_stats GROUP BY snapshot_date""",
    "channel_history": f"SELECT {_CHANNEL} FROM mart_channel_performance",
}
_REPORT_MEANS = {"channel_distribution": exact_mean, "engagement_segments": fixed_point_mean}

for _name, _report in reports.REPORTS.items():
    _options = {"mean": _REPORT_MEANS[_name]} if _name in _REPORT_MEANS else {}
    query(_REPORT_SQL[_name], _name)(
        lambda lake, report=_report, options=_options: report(lake, **options)
    )


# The top-k operators are the limited reports.
for _name, _report in (
    ("topk_geo", "top_geographies"),
    ("topk_device", "device_breakdown"),
    ("topk_visitors", "most_engaged_visitors"),
):
    QUERIES[_name], ORACLES[_name] = QUERIES[_report], ORACLES[_report]


# --- sources and sinks ---------------------------------------------------------------------

@query("""SELECT media_hashed_id AS source_media_id, ingest_date, count(*) AS record_count
    FROM a_events GROUP BY ALL""", "land_raw_json")
def landed_raw_json(lake):
    return lake.raw("events").groupBy("source_media_id", "ingest_date").agg(
        F.count(F.lit(1)).alias("record_count")
    )


@query("""SELECT event_key, visitor_key, media_hashed_id AS media_id, percent_viewed,
    browser, CAST(source_page AS INT) AS page FROM a_events""")
def scan_raw_json(lake):
    return lake.raw("events").select(
        "event_key",
        "visitor_key",
        "media_id",
        to_double("percent_viewed").alias("percent_viewed"),
        F.col("user_agent_details.browser").alias("browser"),
        to_int("_page").alias("page"),
    )


@query("""SELECT media_hashed_id AS source_media_id, ingest_date, TRUE AS has_file,
    load_count FROM a_stats_once""")
def path_metadata(lake):
    return lake.raw("media_stats").select(
        "source_media_id",
        "ingest_date",
        F.col("source_file").contains("media_stats").alias("has_file"),
        to_long("load_count").alias("load_count"),
    )


@query("""SELECT event_key, channel, event_date, percent_viewed FROM fact_media_engagement""")
def scan_parquet(lake):
    base = scratch_path(lake.spark, "gold")
    write_table(lake["fact_media_engagement"], base, "fact_media_engagement")
    return read_table(lake.spark, base, "fact_media_engagement").select(
        "event_key", "channel", "event_date", "percent_viewed"
    )


@query("""SELECT 'fact_media_daily_stats' AS table_name, count(*) AS rows_written,
    count(*) AS rows_read FROM fact_media_daily_stats""")
def sink_parquet(lake):
    base, name = scratch_path(lake.spark, "gold"), "fact_media_daily_stats"
    written = write_table(lake[name], base, name)
    return read_table(lake.spark, base, name).agg(
        F.lit(name).alias("table_name"),
        F.lit(written).cast("bigint").alias("rows_written"),
        F.count(F.lit(1)).alias("rows_read"),
    )


@query("""SELECT c.media_hashed_id, c.channel, c.configured_media_name,
    count(e.event_key) AS event_count FROM a_config c
    LEFT JOIN a_events e ON c.media_hashed_id = e.media_hashed_id GROUP BY ALL""")
def media_config(lake):
    landed = lake.events.groupBy("media_hashed_id").agg(F.count("event_key").alias("n"))
    return lake.config.join(landed, "media_hashed_id", "left").select(
        "media_hashed_id",
        "channel",
        "configured_media_name",
        F.coalesce("n", F.lit(0)).alias("event_count"),
    )


@query("""SELECT 'mart_geo_engagement' AS table_name, channel, count(*) AS place_count,
    CAST(sum(engagement_event_count) AS BIGINT) AS event_count
    FROM mart_geo_engagement GROUP BY channel""")
def catalog_register(lake):
    base, name = scratch_path(lake.spark, "marts"), "mart_geo_engagement"
    database = "marts_" + base.rsplit("-", 1)[1]
    write_table(lake[name], base, name)
    register_tables(lake.spark, database, base, [name])
    return lake.spark.sql(
        f"""SELECT '{name}' AS table_name, channel, count(*) AS place_count,
        sum(engagement_event_count) AS event_count FROM {database}.{name} GROUP BY channel"""
    )


@query("SELECT 'events' AS endpoint, count(*) AS event_count FROM a_events")
def default_ingest_date(lake):
    """Records landed without a date go to today's folder."""
    base = scratch_path(lake.spark, "raw")
    land_raw_json(lake.events.select("event_key"), base, "events", page=F.lit(1))
    landed = lake.spark.read.text(table_path(base, "events"))
    is_today = F.col("ingest_date").cast("string") == today()
    return landed.agg(
        F.lit("events").alias("endpoint"), F.count_if(is_today).alias("event_count")
    )


# --- silver --------------------------------------------------------------------------------

@query("""SELECT p_partkey AS media_numeric_id, concat('m', p_partkey) AS media_hashed_id,
    'Video' AS media_type, p_name AS media_name, p_retailprice AS duration_seconds,
    TIMESTAMP '2024-01-05 08:00:00' AS created_at,
    CASE WHEN p_partkey % 5 <> 0 THEN TIMESTAMP '2024-01-06 10:00:00' END AS updated_at,
    CASE WHEN p_partkey % 4 = 0 THEN 'ready' ELSE 'queued' END AS status,
    p_partkey % 3 = 0 AS archived, concat('about ', p_name) AS description,
    p_partkey AS project_id, concat('p', p_partkey) AS project_hashed_id, p_brand AS project_name,
    CASE WHEN p_partkey % 2 = 1 THEN p_partkey END AS section_id, p_type AS section_name,
    concat('https://share.example/', p_partkey) AS share_url,
    concat('https://cdn.example/', p_partkey) AS thumbnail_url, p_size AS thumbnail_width,
    p_size + 1 AS thumbnail_height, '2024-01-31' AS ingest_date,
    CAST(NULL AS VARCHAR) AS source_media_id FROM part""")
def flatten_media_metadata(lake):
    return _flattened(lake, "media_metadata")


def _flattened(lake, endpoint: str) -> DataFrame:
    """Every silver column, but for the file and the moment of the run."""
    flat = silver.FLATTEN[endpoint](lake.raw(endpoint))
    flat = silver.dedup_events(flat) if endpoint == "events" else flat
    kinds = {c: k for c, k in schemas.column_types(endpoint).items() if c not in UNCOMPARED}
    return flat.select(*[_utc(c) if k == "TIMESTAMP" else c for c, k in kinds.items()])


UNCOMPARED = ("source_file", "silver_processed_at")


def _utc(column: str):
    """The instant as a UTC wall-clock time, whatever zone a client shows instants in."""
    zone = F.current_timezone()
    return F.convert_timezone(zone, F.lit("UTC"), F.col(column).cast("timestamp_ntz")).alias(column)


@query("""SELECT media_hashed_id, load_count, play_count,
    CAST(play_count AS DOUBLE) / CAST(load_count + 1 AS DOUBLE) AS api_play_rate,
    CAST(play_count AS DOUBLE) / CAST(load_count AS DOUBLE) AS calculated_play_rate,
    hours_watched, CAST(visitor_count AS DOUBLE) / CAST(load_count AS DOUBLE) AS engagement,
    visitor_count, ingest_date, media_hashed_id AS source_media_id FROM a_stats_once""")
def flatten_media_stats(lake):
    return _flattened(lake, "media_stats")


@query("""SELECT concat('v', c_custkey) AS visitor_key,
    TIMESTAMP '2024-01-03 00:00:00' AS created_at,
    TIMESTAMP '2024-01-04 00:00:00' + to_seconds(c_custkey % 60) AS last_active_at,
    concat('e', c_custkey) AS last_event_key, c_custkey AS load_count, c_custkey % 9 AS play_count,
    CASE WHEN c_custkey % 2 = 1 THEN concat('e', c_custkey + 1) END AS identifying_event_key,
    c_name AS visitor_name,
    CASE WHEN c_custkey % 3 = 0 THEN concat(c_name, '@example.com') END AS visitor_email,
    c_mktsegment AS visitor_org_name, concat('title ', c_custkey % 3) AS visitor_org_title,
    'Edge' AS browser, CAST(c_custkey % 5 AS VARCHAR) AS browser_version,
    CASE WHEN c_custkey % 2 = 0 THEN 'Android' ELSE 'Mac' END AS platform,
    c_custkey % 2 = 0 AS is_mobile, '2024-01-31' AS ingest_date FROM customer""")
def flatten_visitors(lake):
    return _flattened(lake, "visitors")


@query("""SELECT event_key, received_at, visitor_key, media_hashed_id, media_name, media_url,
    percent_viewed, ip_address, country, region, city, latitude, longitude, organization, email,
    embed_url, conversion_type,
    concat('{"from":"', country, '","to":"', region, '"}') AS conversion_data_json,
    iframe_heatmap_url, browser, browser_version, platform, is_mobile, thumbnail_url,
    thumbnail_width, thumbnail_height, ingest_date, media_hashed_id AS source_media_id, source_page
    FROM ev""")
def flatten_events(lake):
    return _flattened(lake, "events")


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, checksum) of tables; the SQL side is ``oracle.contents``."""
    found = []
    for name, df in tables.items():
        columns = {c: k for c, k in schemas.column_types(name).items() if c not in UNCOMPARED}
        times = {c: F.col(c).cast("timestamp") for c, k in columns.items() if k == "TIMESTAMP"}
        digest = F.md5(F.expr(row_text(columns, "unix_micros")))
        found.append(
            df.withColumns(times).agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.sum(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")).alias("checksum"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def _contents_sql(tables, source: dict[str, str] | None = None) -> str:
    """The same of the oracle's tables; ``source`` says what a silver table is there."""
    source = source or {}
    selects = []
    for name in tables:
        columns = {c: k for c, k in schemas.column_types(name).items() if c not in UNCOMPARED}
        select = contents(name, columns)
        selects.append(select.replace(f"FROM {name}", f"FROM {source[name]}") if name in source else select)
    return " UNION ALL ".join(selects)


# Silver as SQL, from the landed records that belong together.
_SILVER = {
    "events": """(SELECT * REPLACE (concat('{"from":"', country, '","to":"', region, '"}')
        AS conversion_data_json), media_hashed_id AS source_media_id FROM ev) e""",
    "media_metadata": "(SELECT *, CAST(NULL AS VARCHAR) AS source_media_id FROM a_metadata) m",
    "media_stats": """(SELECT *, CAST(play_count AS DOUBLE) / CAST(load_count + 1 AS DOUBLE) AS api_play_rate,
        CAST(play_count AS DOUBLE) / CAST(load_count AS DOUBLE) AS calculated_play_rate,
        CAST(visitor_count AS DOUBLE) / CAST(load_count AS DOUBLE) AS engagement,
        media_hashed_id AS source_media_id FROM a_stats_once) s""",
    "visitors": """(SELECT *, TIMESTAMP '2024-03-01 00:00:00' AS created_at,
        TIMESTAMP '2023-12-01 00:00:00' AS last_active_at, concat('e', k) AS last_event_key,
        k AS load_count, k % 9 AS play_count,
        CASE WHEN k % 2 = 1 THEN concat('e', k + 1) END AS identifying_event_key,
        concat('visitor ', k) AS visitor_name, concat('title ', k % 3) AS visitor_org_title
        FROM (SELECT *, CAST(substr(visitor_key, 2) AS BIGINT) AS k FROM a_visitors)) v""",
}


@query(_contents_sql(schemas.ENDPOINTS, _SILVER))
def run_silver(lake):
    base = scratch_path(lake.spark, "silver")
    silver.run_silver(lake.spark, lake.matching_raw_base(), base)
    return _contents({e: read_table(lake.spark, base, e) for e in schemas.ENDPOINTS})


def _written_silver(lake) -> str:
    base = scratch_path(lake.spark, "silver")
    write_table(silver.dedup_events(lake.events), base, "events")
    write_table(lake.metadata, base, "media_metadata")
    write_table(lake.stats, base, "media_stats")
    write_table(lake.visitors, base, "visitors")
    return base


def _config_items(lake, every_media: bool = False) -> DataFrame:
    return adapters.config(lake.spark, every_media).selectExpr(
        "media_hashed_id AS media_id", "channel", "configured_media_name AS name"
    )


def _written_config(lake, every_media: bool = False) -> str:
    """The configuration as lines, written by Spark."""
    path = f"{scratch_path(lake.spark, 'config')}/media_config.jsonl"
    _config_items(lake, every_media).write.json(path)
    return path


def _written_gold(lake) -> str:
    base = scratch_path(lake.spark, "gold")
    gold.run_gold(
        lake.spark, _written_silver(lake), base, _written_config(lake), events_unique=True
    )
    return base


@query(_contents_sql(schemas.GOLD_TABLES))
def run_gold(lake):
    base = _written_gold(lake)
    return _contents({t: read_table(lake.spark, base, t) for t in schemas.GOLD_TABLES})


@query(_contents_sql(schemas.MART_TABLES))
def run_marts(lake):
    base = scratch_path(lake.spark, "marts")
    marts.run_marts(lake.spark, _written_gold(lake), base, snapshots=True)
    return _contents({t: read_table(lake.spark, base, t) for t in schemas.MART_TABLES})


# Above silver, an event keeps the conversion data of its record.
_FROM_RAW = {
    "fact_media_engagement": """(SELECT * REPLACE (concat('{"from":"', country, '","to":"', region, '"}')
        AS conversion_data_json) FROM fact_media_engagement) f""",
}


@query(_contents_sql((*schemas.GOLD_TABLES, *schemas.MART_TABLES), _FROM_RAW), every_media=True)
def run_lakehouse(lake):
    """From landed JSON to marts, with all checks; the contents are read back from the written tables."""
    layers = {n: scratch_path(lake.spark, n) for n in ("silver", "gold", "marts")}
    config = _written_config(lake, every_media=True)
    lakehouse.run_lakehouse(lake.spark, config, lake.matching_raw_base(), *layers.values())
    bases = {**dict.fromkeys(schemas.GOLD_TABLES, layers["gold"]), **dict.fromkeys(schemas.MART_TABLES, layers["marts"])}
    return _contents({t: read_table(lake.spark, base, t) for t, base in bases.items()})


@query("""SELECT * FROM (
    SELECT 'dim_media: expected row count' AS check_name, count(*) <> 4 AS fails FROM dim_media
    UNION ALL SELECT 'fact_media_engagement: no nulls: channel', count(*) <> count(channel)
        FROM fact_media_engagement
    UNION ALL SELECT concat(t, ': allowed values: channel'), n > 0
        FROM (SELECT count(*) - count(channel) AS n FROM fact_media_engagement),
        (VALUES ('dim_media'), ('fact_media_daily_stats'), ('fact_media_engagement'),
          ('mart_channel_performance'), ('mart_geo_engagement'), ('mart_device_browser')) v(t))
    WHERE fails""")
def run_lakehouse_that_fails(lake):
    """A run over media of which one is in no configuration: the checks that it names as failed."""
    layers = {n: scratch_path(lake.spark, n) for n in ("silver", "gold", "marts")}
    try:
        lakehouse.run_lakehouse(
            lake.spark, _written_config(lake), lake.matching_raw_base(), *layers.values()
        )
        failed = []
    except lakehouse.ValidationFailed as error:
        failed = error.failed
    rows = [(name, True) for name in failed]  # no more than there are checks
    return lake.spark.createDataFrame(rows, "check_name STRING, fails BOOLEAN")


_BROKEN = 97


@query(f"""SELECT * FROM (
    SELECT 'events' AS endpoint, count(*) FILTER (WHERE event_id % {_BROKEN} < 2) AS malformed_rows,
      count(DISTINCT event_type) FILTER (WHERE event_id % {_BROKEN} < 2) > 0 AS in_files,
      count(*) FILTER (WHERE event_id % {_BROKEN} > 1) AS good_rows FROM events
    UNION ALL SELECT 'media_stats', 0, FALSE, count(*) FROM a_stats_once)""")
def quarantine(lake):
    """Records among which some are no JSON, or no event: each goes to its own sink in one read."""
    raw, base = scratch_path(lake.spark, "raw"), scratch_path(lake.spark, "silver")
    events = adapters.read(lake.spark, lake.folder, "events")
    good = F.to_json(F.struct(F.concat(F.lit("e"), "event_id").alias("event_key"), "value"))
    text = (
        F.when(F.col("event_id") % _BROKEN == 0, F.concat(F.lit("<html>"), "event_id"))
        .when(F.col("event_id") % _BROKEN == 1, F.to_json(F.struct(F.col("event_id").alias("error"))))
        .otherwise(good)
    )
    lines = events.select(text.alias("value"), F.col("event_type").alias("media_id"))
    lines.write.partitionBy("media_id").text(table_path(raw, "events"))
    lake.land(raw, "media_stats", adapters.raw_stats, "media")
    written = silver.run_silver(lake.spark, raw, base)
    good_rows = lake.spark.createDataFrame(list(written.items()), "endpoint STRING, good_rows BIGINT")
    return silver.quarantine_counts(lake.spark, base).join(good_rows, "endpoint").select(
        "endpoint", "malformed_rows", (F.col("files") > 0).alias("in_files"), "good_rows"
    )


@query("""SELECT media_hashed_id AS source_media_id, ingest_date, count(*) AS record_count
    FROM a_events GROUP BY ALL""")
def land_raw_json_again(lake):
    """A batch landed twice, and one that was never committed: its records are there once, the other's not."""
    base, events = scratch_path(lake.spark, "raw"), adapters.raw_events(lake.spark, lake.folder)
    for _ in range(2):
        lake.land(base, "events", events, "media_id", "page")
    unfinished = f"{table_path(base, 'events')}/batch=second/media_id=view/ingest_date={adapters.SECOND_BATCH}"
    events.select(F.to_json(F.struct("event_key")).alias("value")).write.text(unfinished)
    scanned = with_path_metadata(scan_raw(lake.spark, base, "events"))
    return scanned.groupBy("source_media_id", "ingest_date").agg(F.count(F.lit(1)).alias("record_count"))


@query("""SELECT endpoint, endpoint = 'events' AS built, CASE endpoint WHEN 'events' THEN n ELSE 0 END AS row_count
    FROM (VALUES ('events'), ('media_metadata'), ('media_stats'), ('visitors')) v(endpoint),
    (SELECT count(*) AS n FROM ev)""")
def empty_input_skip(lake):
    """Endpoints without a folder, without files and without records are left out of the run."""
    raw, base = scratch_path(lake.spark, "raw"), scratch_path(lake.spark, "silver")
    lake.land(raw, "events", adapters.raw_events, "media_id", "page")
    lake.spark.range(0).selectExpr("CAST(id AS STRING) AS value").write.text(table_path(raw, "media_stats"))
    lake.spark.range(3).selectExpr("'[]' AS value").write.text(table_path(raw, "visitors"))
    written = silver.run_silver(lake.spark, raw, base)
    rows = [(e, e in written, written.get(e, 0)) for e in schemas.ENDPOINTS]
    return lake.spark.createDataFrame(rows, "endpoint STRING, built BOOLEAN, row_count BIGINT")


@query("""SELECT form, channel, count(event_key) AS event_count
    FROM (VALUES ('document'), ('folder'), ('lines'), ('table')) f(form), a_config c
    LEFT JOIN a_events e ON c.media_hashed_id = e.media_hashed_id GROUP BY form, channel""")
def media_config_forms(lake):
    """Events per channel by the configuration in each of its forms."""
    base, items = scratch_path(lake.spark, "config"), _config_items(lake)
    document = items.agg(F.collect_list(F.struct("*")).alias("media_ids"))  # a document is one row
    document.write.json(f"{base}/document.json")
    items.repartition(3).write.json(f"{base}/folder.jsonl")
    items.coalesce(1).write.json(f"{base}/lines.jsonl")
    items.write.parquet(f"{base}/table.parquet")
    counts = lake.events.groupBy("media_hashed_id").agg(F.count("event_key").alias("n"))
    found = []
    for name in ("document.json", "folder.jsonl", "lines.jsonl", "table.parquet"):
        config = load_media_config(lake.spark, f"{base}/{name}")
        joined = config.join(counts, "media_hashed_id", "left").groupBy("channel")
        total = F.coalesce(F.sum("n"), F.lit(0)).alias("event_count")
        found.append(joined.agg(total).select(F.lit(name.split(".")[0]).alias("form"), "channel", "event_count"))
    return reduce(DataFrame.unionByName, found)


@query("""SELECT 'UTC' AS zone, CAST(received_at AS DATE) AS event_date, count(*) AS event_count
    FROM a_events GROUP BY ALL""")
def session_zone(lake):
    """Calendar days of instants, in the zone that the jobs ask the session for."""
    require_utc(lake.spark)
    instant = F.to_timestamp(F.concat(F.col("received_at").cast("string"), F.lit("Z")))
    days = lake.events.select(F.to_date(instant).alias("event_date")).groupBy("event_date")
    zone = F.lit(lake.spark.conf.get("spark.sql.session.timeZone")).alias("zone")
    return days.agg(F.count(F.lit(1)).alias("event_count")).select(zone, "event_date", "event_count")


# --- tables ---------------------------------------------------------------------------------

@query("""SELECT visitor_key, event_count, channels_seen, visitor_org_name FROM
    (SELECT visitor_key, count(*) AS event_count, string_agg(DISTINCT channel, ' | ' ORDER BY channel)
      AS channels_seen FROM fact_media_engagement GROUP BY visitor_key)
    JOIN known_visitors USING (visitor_key)""")
def clustered_join(lake):
    """Visitors and their events from tables clustered by visitor, joined without a shuffle."""
    database, base = _database("clustered"), scratch_path(lake.spark, "clustered")
    fact = lake["fact_media_engagement"].select("visitor_key", "event_key", "channel")
    write_clustered(fact, database, base, "fact", "visitor_key", 8)
    write_clustered(lake.visitors, database, base, "visitors", "visitor_key", 8, ("ingest_date",))
    events = lake.spark.table(f"{database}.fact").groupBy("visitor_key").agg(
        F.count(F.lit(1)).alias("event_count"), distinct_text("channel").alias("channels_seen")
    )
    known = gold.dedup_visitors(lake.spark.table(f"{database}.visitors"))
    return events.join(known, "visitor_key").select(
        "visitor_key", "event_count", "channels_seen", "visitor_org_name"
    )


def _database(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query("SELECT event_key, ingest_date, source_page FROM ev")
def clustered_dedup(lake):
    """Events clustered by key, deduplicated without a shuffle."""
    database, base = _database("clustered"), scratch_path(lake.spark, "clustered")
    used = lake.events.select("event_key", "ingest_date", "source_page", "source_file")
    write_clustered(used, database, base, "events", "event_key", 8, ("ingest_date",))
    return silver.dedup_events(lake.spark.table(f"{database}.events")).drop("source_file")


@query("""SELECT snapshot_date, media_hashed_id, CASE snapshot_date WHEN '2024-01-20' THEN load_count + 1
    ELSE load_count END AS load_count FROM fact_media_daily_stats""")
def replace_snapshot(lake):
    """A table by snapshot, of which one snapshot is written again."""
    base, name = scratch_path(lake.spark, "gold"), "fact_media_daily_stats"
    write_table(lake[name], base, name, snapshots=True)
    again = read_table(lake.spark, base, name).where("snapshot_date = '2024-01-20'")
    other = scratch_path(lake.spark, "gold")
    write_table(again.withColumn("load_count", F.col("load_count") + 1), other, name)
    write_table(read_table(lake.spark, other, name), base, name, snapshots=True)
    return read_table(lake.spark, base, name).select("snapshot_date", "media_hashed_id", "load_count")


@query("""SELECT table_name, column_name, ordinal_position AS position,
    CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
      WHEN 'INTEGER' THEN 'int'      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS data_type
    FROM information_schema.columns WHERE table_name IN ('events', 'nation')""", "describe_tables")
def described_tables(lake):
    """Tables of a database with their columns, as the catalog knows them."""
    database = _database("described")
    register_tables(lake.spark, database, lake.folder, ["events.parquet", "nation.parquet"])
    found = describe_tables(lake.spark, database)
    return found.select("table_name", "column_name", "position", "data_type")


@query("""SELECT 'events' AS table_name, count(*) AS row_count, 'event_id' AS column_name,
    count(*) - count(event_id) AS null_count, CAST(min(event_id) AS VARCHAR) AS least,
    CAST(max(event_id) AS VARCHAR) AS most FROM events
    UNION ALL SELECT 'nation', count(*), 'n_nationkey', count(*) - count(n_nationkey),
    CAST(min(n_nationkey) AS VARCHAR), CAST(max(n_nationkey) AS VARCHAR) FROM nation""", "table_statistics")
def analysed_tables(lake):
    """What the catalog knows of analysed tables."""
    database = _database("analysed")
    register_tables(lake.spark, database, lake.folder, ["events.parquet", "nation.parquet"])
    analyze_tables(lake.spark, database, ["events", "nation"])
    found = table_statistics(lake.spark, database).where("column_name IN ('event_id', 'n_nationkey')")
    return found.select(
        "table_name", "row_count", "column_name", "null_count", F.col("min").alias("least"),
        F.col("max").alias("most"),
    )


@query("SELECT 'events' AS table_name, count(*) AS row_count, max(event_id) AS last_id FROM events")
def footer_counts(lake):
    """Rows of a given table, and its greatest id, from Parquet footers alone."""
    counted = footers(lake.spark, lake.folder, "events.parquet").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("event_id").alias("last_id")
    )
    return counted.select(F.lit("events").alias("table_name"), "row_count", "last_id")


@query("""SELECT e.user_id, u.name, count(*) AS event_count FROM events e
    LEFT JOIN (SELECT c_custkey AS user_id, c_name AS name FROM customer) u ON e.user_id = u.user_id
    GROUP BY ALL""")
def spread_join(lake):
    """Events joined with customers by a key that may be hot, over salts."""
    events = adapters.read(lake.spark, lake.folder, "events").select("event_id", "user_id")
    names = adapters.read(lake.spark, lake.folder, "customer").selectExpr("c_custkey AS user_id", "c_name AS name")
    joined = spread_left_join(events, names, "user_id")
    return joined.groupBy("user_id", "name").agg(F.count(F.lit(1)).alias("event_count"))


@query(f"SELECT city, {text_list('event_key')} AS event_keys FROM a_events GROUP BY city")
def list_segments(lake):
    """Lists too long for a task, built in segments across tasks and put together by the reader."""
    segments = text_segments(lake.events, ["city"], "event_key", segment_bytes=2000, tasks=8)
    return whole_texts(segments, ["city"]).withColumnRenamed("text", "event_keys")


# --- projections and filters ---------------------------------------------------------------

@query("""SELECT visitor_key, visitor_email, CAST(NULL AS VARCHAR) AS visitor_org_title,
    CAST(NULL AS BIGINT) AS load_count FROM a_visitors""")
def safe_col(lake):
    """Absent columns become typed NULLs."""
    return lake.visitors.select("visitor_key", "visitor_email", "visitor_org_title", "load_count")


@query("SELECT event_key, browser, platform, is_mobile FROM a_events")
def safe_nested_col(lake):
    agent = "user_agent_details"
    return lake.raw("events").select(
        "event_key", f"{agent}.browser", f"{agent}.platform",
        to_boolean(f"{agent}.mobile").alias("is_mobile"),
    )


_NAMES = "SELECT column_name FROM information_schema.columns WHERE table_name = 'events'"


@query(f"""SELECT 'events' AS table_name, count(*) AS row_count, 'value' IN ({_NAMES}) AS has_value,
    'rating' IN ({_NAMES}) AS has_rating FROM events""")
def column_exists(lake):
    source = adapters.read(lake.spark, lake.folder, "events")
    return source.agg(
        F.lit("events").alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit("value" in source.columns).alias("has_value"),
        F.lit("rating" in source.columns).alias("has_rating"),
    )


@query("SELECT event_id, value FROM events")
def select_existing(lake):
    source = adapters.read(lake.spark, lake.folder, "events")
    return schemas.select_existing(source, ["event_id", "rating", "value"])


@query("""SELECT event_id AS event_id, user_id AS user_id_raw, value AS value_in FROM events""",
       "snake_case_columns")
def snake_case_columns_of_events(lake):
    source = adapters.read(lake.spark, lake.folder, "events")
    odd = source.select(
        F.col("event_id").alias(" Event-ID "),
        F.col("user_id").alias("user__ID (raw)"),
        F.col("value").alias("VALUE[in]"),
    )
    return snake_case_columns(odd)


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS received_at
    FROM events""")
def cast_datetime(lake):
    text = F.when(F.col("event_id") % 3 == 0, "nope").otherwise(F.col("ts").cast("string"))
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id", to_timestamp(text).cast("timestamp_ntz").alias("received_at")
    )


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS as_double,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS as_long
    FROM events""")
def cast_numeric(lake):
    text = F.when(F.col("event_id") % 3 == 0, "abc").otherwise(F.col("value").cast("string"))
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id", to_double(text).alias("as_double"), to_long(text).alias("as_long")
    )


@query("""SELECT event_key AS media_engagement_key, event_key, visitor_key AS visitor_key_dim,
    visitor_key FROM ev""")
def key_aliases(lake):
    return silver.dedup_events(lake.events).select(
        F.col("event_key").alias("media_engagement_key"), "event_key",
        F.col("visitor_key").alias("visitor_key_dim"), "visitor_key",
    )


@query("""SELECT event_key, percent_viewed >= 0.95 AS is_completed, is_mobile
    FROM fact_media_engagement WHERE percent_viewed >= 0.95 AND is_mobile""")
def comparison_predicates(lake):
    return (
        lake["fact_media_engagement"]
        .where(completed() & F.col("is_mobile"))
        .select("event_key", completed().alias("is_completed"), "is_mobile")
    )


@query("""SELECT CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT)
    AS malformed_rows FROM events""")
def type_guard(lake):
    """Error responses landed in place of events have no event and no visitor key."""
    base = scratch_path(lake.spark, "raw")
    is_error = F.col("event_type") == "error"
    key = F.concat(F.lit("e"), F.col("event_id"))
    records = adapters.read(lake.spark, lake.folder, "events").select(
        F.when(~is_error, key).alias("event_key"),
        F.when(is_error, F.col("props")).alias("error"),
    )
    land_raw_json(records, base, "events", page=F.lit(1))
    malformed = silver.malformed_event_rows(silver.scan_raw_json(lake.spark, base, "events"))
    return malformed.agg(F.sum("malformed_rows").alias("malformed_rows"))


# --- joins ---------------------------------------------------------------------------------

@query("""SELECT m.media_hashed_id, ingest_date, media_name, channel, configured_media_name
    FROM a_metadata m LEFT JOIN a_config c ON m.media_hashed_id = c.media_hashed_id""")
def join_media_config(lake):
    return lake.metadata.join(lake.config, "media_hashed_id", "left").select(
        "media_hashed_id", "ingest_date", "media_name", "channel", "configured_media_name"
    )


@query("""SELECT s.media_hashed_id, ingest_date, source_file, load_count, channel
    FROM a_stats s LEFT JOIN a_config c ON s.media_hashed_id = c.media_hashed_id""")
def join_stats_channel(lake):
    return gold.with_channel(lake.stats, lake.config).select(
        "media_hashed_id", "ingest_date", "source_file", "load_count", "channel"
    )


@query("""SELECT e.media_hashed_id, event_key, ingest_date, channel
    FROM a_events e LEFT JOIN a_config c ON e.media_hashed_id = c.media_hashed_id""")
def join_events_channel(lake):
    return gold.with_channel(lake.events, lake.config).select(
        "media_hashed_id", "event_key", "ingest_date", "channel"
    )


@query("""SELECT e.visitor_key, e.event_count, v.visitor_email, v.visitor_org_name
    FROM (SELECT visitor_key, count(*) AS event_count FROM a_events GROUP BY visitor_key) e
    LEFT JOIN known_visitors v ON e.visitor_key = v.visitor_key""")
def join_visitor_summary(lake):
    totals = lake.events.groupBy("visitor_key").agg(F.count(F.lit(1)).alias("event_count"))
    known = gold.dedup_visitors(lake.visitors)
    return totals.join(known, "visitor_key", "left").select(
        "visitor_key", "event_count", "visitor_email", "visitor_org_name"
    )


@query("""SELECT s.snapshot_date, s.channel, total_load_count, engagement_event_count
    FROM stats_agg s LEFT JOIN engagement_agg e ON s.channel = e.channel""")
def join_stats_engagement(lake):
    totals = marts.stats_by_snapshot_and_channel(lake["fact_media_daily_stats"])
    engaged = marts.engagement_by_channel(lake["fact_media_engagement"], exact_mean)
    return totals.join(engaged, "channel", "left").select(
        "snapshot_date", "channel", "total_load_count", "engagement_event_count"
    )


@query("""SELECT s.snapshot_date, s.channel, total_play_count, media_names
    FROM stats_agg s LEFT JOIN names n ON s.channel = n.channel""")
def join_media_names(lake):
    totals = marts.stats_by_snapshot_and_channel(lake["fact_media_daily_stats"])
    names = marts.media_names_by_channel(lake["dim_media"])
    return totals.join(names, "channel", "left").select(
        "snapshot_date", "channel", "total_play_count", "media_names"
    )


@query("""SELECT d.visitor_key, event_count, channels_seen, media_seen, completed_event_count
    FROM dim_visitor d LEFT JOIN viewing v ON d.visitor_key = v.visitor_key""")
def join_visitor_channels(lake):
    fact = gold.build_fact_media_engagement(lake.unique_events, lake.config, True)
    viewing = marts.visitor_viewing(fact)
    return lake["dim_visitor"].join(viewing, "visitor_key", "left").select(
        "visitor_key", "event_count", "channels_seen", "media_seen", "completed_event_count"
    )


@query("""SELECT media_daily_stats_key, snapshot_date, load_count FROM fact_media_daily_stats
    WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_media_daily_stats)""")
def latest_snapshot_join(lake):
    return reports.latest_snapshot(lake, "fact_media_daily_stats").select(
        "media_daily_stats_key", "snapshot_date", "load_count"
    )


# --- aggregations and windows --------------------------------------------------------------

@query("SELECT count(*) AS row_count FROM a_events")
def count_rows(lake):
    return lake.events.agg(F.count(F.lit(1)).alias("row_count"))


@query("""SELECT media_hashed_id, count(browser) AS with_browser, count(email) AS with_email
    FROM a_events GROUP BY media_hashed_id""")
def count_nonnull(lake):
    return lake.events.groupBy("media_hashed_id").agg(
        F.count("browser").alias("with_browser"), F.count("email").alias("with_email")
    )


@query("""SELECT media_hashed_id, count(DISTINCT visitor_key) AS visitors
    FROM a_events GROUP BY media_hashed_id""")
def count_distinct(lake):
    return lake.events.groupBy("media_hashed_id").agg(
        F.count_distinct("visitor_key").alias("visitors")
    )


@query("""SELECT count(*) AS total, count(DISTINCT event_key) AS events,
    count(DISTINCT visitor_key) AS visitors, count(DISTINCT browser) AS browsers,
    count(DISTINCT media_hashed_id) AS media, min(received_at) AS first_at,
    max(received_at) AS last_at FROM a_events""")
def multi_distinct(lake):
    distinct = {
        "events": "event_key", "visitors": "visitor_key", "browsers": "browser",
        "media": "media_hashed_id",
    }
    totals = {
        "total": rows_total(), "first_at": Total("min", F.col("received_at")),
        "last_at": Total("max", F.col("received_at")),
    }
    return distinct_counts(lake.events, distinct, totals)


@query("""SELECT ingest_date, CAST(sum(load_count) AS BIGINT) AS loads,
    CAST(sum(visitor_count) AS BIGINT) AS visitors FROM a_stats GROUP BY ingest_date""", "sum")
def sum_of_counts(lake):
    return lake.stats.groupBy("ingest_date").agg(
        F.sum("load_count").alias("loads"), F.sum("visitor_count").alias("visitors")
    )


@query(f"""SELECT city, {mean4('percent_viewed')} AS avg_percent_viewed
    FROM a_events GROUP BY city""", "avg")
def mean_of_shares(lake):
    return lake.events.groupBy("city").agg(
        exact_mean(F.col("percent_viewed")).alias("avg_percent_viewed")
    )


@query("""SELECT country, min(received_at) AS first_at, max(received_at) AS last_at,
    min(percent_viewed) AS least, max(percent_viewed) AS most, max(city) AS last_city
    FROM a_events GROUP BY country""")
def min_max(lake):
    return lake.events.groupBy("country").agg(
        F.min("received_at").alias("first_at"),
        F.max("received_at").alias("last_at"),
        F.min("percent_viewed").alias("least"),
        F.max("percent_viewed").alias("most"),
        F.max("city").alias("last_city"),
    )


@query("""SELECT region, count(*) FILTER (WHERE percent_viewed >= 0.95) AS completed,
    count(*) FILTER (WHERE is_mobile) AS mobile,
    count(*) FILTER (WHERE browser IS NULL) AS no_browser FROM a_events GROUP BY region""")
def conditional_count(lake):
    return lake.events.groupBy("region").agg(
        F.count_if(completed()).alias("completed"),
        F.count_if(F.col("is_mobile")).alias("mobile"),
        F.count_if(F.col("browser").isNull()).alias("no_browser"),
    )


@query("""SELECT visitor_key, ip_address, longitude, email, browser, ingest_date
    FROM profiles""")
def last_nonnull(lake):
    attributes = LatestValues(
        ("received_at", "event_key"),
        (("ip_address", "longitude"), ("email",), ("browser",), ("ingest_date",)),
    )
    unique = silver.dedup_events(lake.events)
    latest = unique.groupBy("visitor_key").agg(*attributes.aggregates)
    return attributes.resolve(latest)


@query(f"""SELECT city, {text_list('email')} AS emails, {text_list('media_hashed_id')} AS media
    FROM a_events GROUP BY city""")
def collect_sorted_join(lake):
    return lake.events.groupBy("city").agg(
        distinct_text("email").alias("emails"), distinct_text("media_hashed_id").alias("media")
    )


@query("""SELECT engagement_segment, count(*) AS visitors
    FROM mart_visitor_engagement GROUP BY engagement_segment""")
def group_by_one_key(lake):
    return lake["mart_visitor_engagement"].groupBy("engagement_segment").agg(
        F.count(F.lit(1)).alias("visitors")
    )


@query("""SELECT platform, browser, is_mobile, count(*) AS event_count
    FROM a_events GROUP BY platform, browser, is_mobile""")
def group_by_null_keys(lake):
    return lake.events.groupBy("platform", "browser", "is_mobile").agg(
        F.count(F.lit(1)).alias("event_count")
    )


@query("SELECT event_key, ingest_date, source_page FROM ev")
def dedup_events(lake):
    return silver.dedup_events(lake.events).select("event_key", "ingest_date", "source_page")


@query("""SELECT media_hashed_id, ingest_date AS snapshot_date, source_file FROM a_stats
    WHERE source_file = 'f2'""")
def dedup_daily_stats(lake):
    snapshots = lake.stats.withColumn("snapshot_date", F.col("ingest_date"))
    return gold.dedup_daily_stats(snapshots).select(
        "media_hashed_id", "snapshot_date", "source_file"
    )


@query("SELECT visitor_key, visitor_org_name, ingest_date FROM known_visitors")
def dedup_visitors(lake):
    return gold.dedup_visitors(lake.visitors).select(
        "visitor_key", "visitor_org_name", "ingest_date"
    )


@query("""SELECT count(*) AS total_rows, count(*) - count(DISTINCT email) AS duplicate_count
    FROM a_events""")
def duplicate_count(lake):
    rows = F.count(F.lit(1))
    return lake.events.agg(
        rows.alias("total_rows"), (rows - F.count_distinct("email")).alias("duplicate_count")
    )


@query("""SELECT media_hashed_id, media_name, updated_at, ingest_date FROM a_metadata
    QUALIFY row_number() OVER (PARTITION BY media_hashed_id ORDER BY updated_at DESC NULLS LAST,
    ingest_date DESC NULLS LAST, source_file DESC NULLS LAST) = 1""")
def latest_media_row(lake):
    newest = [F.desc_nulls_last(c) for c in ("updated_at", "ingest_date", "source_file")]
    return keep_first(lake.metadata, ["media_hashed_id"], newest).select(
        "media_hashed_id", "media_name", "updated_at", "ingest_date"
    )


@query("""SELECT visitor_key, event_key, received_at FROM ev
    QUALIFY row_number() OVER (PARTITION BY visitor_key ORDER BY received_at DESC, event_key) = 1""")
def row_number_filter(lake):
    newest = Window.partitionBy("visitor_key").orderBy(F.desc("received_at"), "event_key")
    numbered = silver.dedup_events(lake.events).withColumn("n", F.row_number().over(newest))
    return numbered.where("n = 1").select("visitor_key", "event_key", "received_at")


# --- sorts, sets ---------------------------------------------------------------------------

@query("""SELECT event_key, channel, received_at, row_number() OVER (ORDER BY channel NULLS LAST,
    received_at NULLS LAST, event_key NULLS LAST) AS position FROM fact_media_engagement""")
def order_by_keys(lake):
    """Rows in order, each with its place in it."""
    facts = lake["fact_media_engagement"].select("event_key", "channel", "received_at")
    return with_positions(facts.orderBy(*reports.ascending("channel", "received_at", "event_key")))


@query("""SELECT event_key, CAST(NULL AS DOUBLE) AS hours_watched, media_hashed_id FROM ev
    UNION ALL SELECT NULL, hours_watched, media_hashed_id FROM a_stats""")
def union_missing_columns(lake):
    left = silver.dedup_events(lake.events).select("event_key", "media_hashed_id")
    right = lake.stats.select("hours_watched", "media_hashed_id")
    return left.unionByName(right, allowMissingColumns=True)


# --- scalar functions ----------------------------------------------------------------------

@query(f"""SELECT event_id, {rate('user_id', '(event_id % 4)')} AS quotient FROM events""",
       "safe_divide")
def safe_divide_query(lake):
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id", safe_divide(F.col("user_id"), F.col("event_id") % 4).alias("quotient")
    )


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 0
    THEN CAST(user_id AS DOUBLE) / CAST(event_id % 4 AS DOUBLE) END AS rate FROM events""",
       "play_rate")
def play_rate_query(lake):
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id", play_rate(F.col("user_id"), F.col("event_id") % 4).alias("rate")
    )


@query("SELECT event_key, coalesce(email, organization, visitor_key) AS contact FROM a_events")
def coalesce(lake):
    return lake.events.select(
        "event_key", F.coalesce("email", "organization", "visitor_key").alias("contact")
    )


@query("""SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
    nullif(regexp_extract(props, '"z": ([0-9]+)', 1), '') AS z FROM events""")
def regexp_extract(lake):
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id",
        to_int(F.regexp_extract("props", "([0-9]+)", 1)).alias("k"),
        F.nullif(F.regexp_extract("props", '"z": ([0-9]+)', 1), F.lit("")).alias("z"),
    )


@query("""SELECT event_key, CASE WHEN percent_viewed <= 0.25 THEN '0-25%'
    WHEN percent_viewed <= 0.5 THEN '26-50%' WHEN percent_viewed <= 0.75 THEN '51-75%'
    ELSE '76-100%' END AS segment FROM a_events""", "engagement_segment")
def segment_of_events(lake):
    return lake.events.select(
        "event_key", engagement_segment(F.col("percent_viewed")).alias("segment")
    )


@query("SELECT event_key, CAST(received_at AS DATE) AS event_date FROM a_events")
def to_date(lake):
    return lake.events.select("event_key", F.to_date("received_at").alias("event_date"))


@query("""SELECT concat_ws('_', media_hashed_id, email, ingest_date) AS joined, count(*) AS n
    FROM a_events GROUP BY ALL""")
def concat_ws(lake):
    joined = F.concat_ws("_", "media_hashed_id", "email", "ingest_date").alias("joined")
    return lake.events.groupBy(joined).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, replace(props, ' ', '') AS json, 'n/a' AS other FROM events""",
       "json_text")
def json_text_query(lake):
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id", json_text("props").alias("json"),
        json_text(F.when(F.col("event_id") >= 0, "n/a")).alias("other"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id END AS section_id,
    event_type AS section_name FROM events""", "polymorphic_section")
def polymorphic_section(lake):
    source = adapters.read(lake.spark, lake.folder, "events")
    as_object = F.to_json(F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name")))
    section = F.when(F.col("event_id") % 2 == 0, as_object).otherwise(F.col("event_type"))
    section_id, name = section_parts("section")
    return source.withColumn("section", section).select(
        "event_id", section_id.alias("section_id"), name.alias("section_name")
    )


@query("""SELECT event_id, date_diff('day', CAST(ts AS DATE), today()) AS days_since,
    strftime(today(), '%Y-%m-%d') AS ingest_date FROM events""")
def processing_time(lake):
    return adapters.read(lake.spark, lake.folder, "events").select(
        "event_id",
        F.date_diff(F.to_date(F.current_timestamp()), F.to_date("ts")).cast("bigint").alias("days_since"),
        today().alias("ingest_date"),
    )


# --- data quality --------------------------------------------------------------------------

FACT = "fact_media_engagement"


def _fact_check(name: str, passed: str, message: str = "") -> str:
    shown = f", {message} AS message" if message else ""
    return f"SELECT '{FACT}: {name}' AS check_name, {passed} AS passed{shown} FROM {FACT}"


def _one_check(lake, check, *args) -> DataFrame:
    fact = lake[FACT]
    return quality.evaluate(fact, [check(fact, FACT, *args)]).drop("check_no")


@query("""SELECT concat('Lake table exists: ', t) AS check_name, t = 'dim_media' AS passed,
    n AS dim_media_rows FROM (VALUES ('dim_media'), ('dim_visitor')) v(t)
    CROSS JOIN (SELECT count(*) AS n FROM dim_media)""")
def check_exists(lake):
    base = scratch_path(lake.spark, "gold")
    rows = write_table(lake["dim_media"], base, "dim_media")
    found = {t: find_table(lake.spark, base, t) for t in ("dim_media", "dim_visitor")}
    results = quality.layer_checks(lake.spark, "Lake", found, CHANNELS)
    return results.select(
        "check_name", "passed", F.lit(rows).cast("bigint").alias("dim_media_rows")
    )


@query(_fact_check("non-empty", "count(*) > 0", "concat('rows: ', count(*))"))
def check_non_empty(lake):
    return _one_check(lake, quality.non_empty)


@query(_fact_check("expected row count", "count(*) = 10", "concat('rows: ', count(*), '; wanted: 10')"))
def check_row_count(lake):
    return _one_check(lake, quality.row_count, 10)


@query(f"""SELECT concat('events: column exists: ', c) AS check_name, c IN ({_NAMES}) AS passed,
    concat('the table has [', (SELECT string_agg(concat(chr(39), column_name, chr(39)), ', ' ORDER BY ordinal_position)
      FROM information_schema.columns WHERE table_name = 'events'), ']') AS message
    FROM (VALUES ('rating'), ('value')) v(c)""")
def check_column(lake):
    source = adapters.read(lake.spark, lake.folder, "events")
    checks = [quality.column_exists(source, "events", c) for c in ("rating", "value")]
    return quality.evaluate(source, checks).drop("check_no")


@query(f"""SELECT 'events: required columns' AS check_name, count(*) = 0 AS passed,
    CASE WHEN count(*) = 0 THEN 'none missing'
      ELSE concat('missing: [', string_agg(concat(chr(39), c, chr(39)), ', ' ORDER BY n), ']') END AS message
    FROM (VALUES (1, 'event_id', 1), (2, 'rating', 1), (3, 'score', 1), (4, 'event_id', 2), (5, 'value', 2)) v(n, c, k)
    WHERE c NOT IN ({_NAMES}) GROUP BY k
    UNION ALL SELECT 'events: required columns', TRUE, 'none missing'
    WHERE (SELECT count(*) FROM information_schema.columns WHERE table_name = 'events'
      AND column_name IN ('event_id', 'value')) = 2""")
def check_required_columns(lake):
    source = adapters.read(lake.spark, lake.folder, "events")
    required = (["event_id", "rating", "score"], ["event_id", "value"])
    checks = [quality.required_columns(source, "events", columns) for columns in required]
    return quality.evaluate(source, checks).drop("check_no")


@query(_fact_check("no nulls: browser", "count(*) = count(browser)",
                   "concat('rows without a value: ', count(*) - count(browser))"))
def check_no_nulls(lake):
    return _one_check(lake, quality.no_nulls, "browser")


@query(_fact_check(
    "unique: email", "count(*) - count(DISTINCT email) - 1 = 0",
    "concat('rows beyond the first of their value: ', count(*) - count(DISTINCT email) - 1)"))
def check_unique(lake):
    return _one_check(lake, quality.unique, "email")


@query(_fact_check(
    "allowed values: media_hashed_id",
    "count(*) FILTER (WHERE media_hashed_id IN ('click', 'view')) = count(*)",
    """concat('rows without a value: 0; rows with another value: ',
    count(*) FILTER (WHERE media_hashed_id NOT IN ('click', 'view')), '; other values: ',
    count(DISTINCT media_hashed_id) FILTER (WHERE media_hashed_id NOT IN ('click', 'view')))"""))
def check_allowed_values(lake):
    return _one_check(lake, quality.allowed_values, "media_hashed_id", ["view", "click"])


@query(f"""SELECT visitor_key AS value, count(*) AS rows FROM {FACT}
    WHERE visitor_key IS NULL OR visitor_key NOT IN ('v1', 'v2') GROUP BY visitor_key""")
def unexpected_values(lake):
    """All values that a check of allowed values finds, however many."""
    return quality.unexpected_values(lake[FACT], "visitor_key", ["v1", "v2"])


@query(_fact_check("numeric range: percent_viewed",
                   "min(percent_viewed) >= 0.5 AND max(percent_viewed) <= 1"))
def check_range(lake):
    return _one_check(lake, quality.numeric_range, "percent_viewed", 0.5, 1.0).drop("message")


# The checks of both layers, spelled one by one: what has to hold in SQL. Four media are configured; media
# and channels have a row for each day with statistics. A list of columns means that all are there.
_SHARE = "coalesce(min({0}) >= 0 AND max({0}) <= 1, FALSE)"
_ONCE = "count(*) = (SELECT count(*) FROM (SELECT DISTINCT {0} FROM {1}))"
_CHANNEL_OK = "count(*) = count(*) FILTER (WHERE channel = 'Facebook' OR channel = 'YouTube')"
_CATALOGUE = {
    "dim_media": {
        "non-empty": "count(*) > 0",
        "expected row count": "count(*) = 4",
        "required columns": "media_key, media_hashed_id, channel, media_name, duration_seconds, status, ingest_date",
        "no nulls: media_hashed_id": "count(media_hashed_id) = count(*)",
        "unique: media_hashed_id": _ONCE.format("media_hashed_id", "dim_media"),
        "allowed values: channel": _CHANNEL_OK,
    },
    "fact_media_daily_stats": {
        "non-empty": "count(*) > 0",
        "expected row count": "count(*) = (SELECT count(*) FROM a_stats_once)",
        "required columns": """media_daily_stats_key, media_hashed_id, channel, snapshot_date, load_count, play_count,
            hours_watched, engagement, visitor_count""",
        "no nulls: media_daily_stats_key": "count(media_daily_stats_key) = count(*)",
        "unique: media_daily_stats_key": _ONCE.format("media_daily_stats_key", "fact_media_daily_stats"),
        "allowed values: channel": _CHANNEL_OK,
    },
    "fact_media_engagement": {
        "non-empty": "count(*) > 0",
        "required columns": """media_engagement_key, event_key, received_at, event_date, media_hashed_id, channel,
            visitor_key, percent_viewed, ingest_date""",
        "no nulls: event_key": "count(event_key) = count(*)",
        "unique: event_key": _ONCE.format("event_key", "fact_media_engagement"),
        "no nulls: media_hashed_id": "count(media_hashed_id) = count(*)",
        "no nulls: channel": "count(channel) = count(*)",
        "no nulls: visitor_key": "count(visitor_key) = count(*)",
        "allowed values: channel": _CHANNEL_OK,
        "numeric range: percent_viewed": _SHARE.format("percent_viewed"),
    },
    "dim_visitor": {
        "non-empty": "count(*) > 0",
        "required columns": """visitor_key, first_seen_at, last_seen_at, event_count, avg_percent_viewed,
            media_count, ingest_date""",
        "no nulls: visitor_key": "count(visitor_key) = count(*)",
        "unique: visitor_key": _ONCE.format("visitor_key", "dim_visitor"),
        "numeric range: avg_percent_viewed": _SHARE.format("avg_percent_viewed"),
        "numeric range: max_percent_viewed": _SHARE.format("max_percent_viewed"),
    },
    "mart_channel_performance": {
        "non-empty": "count(*) > 0",
        "expected row count": """count(*) =
            (SELECT count(*) FROM (SELECT DISTINCT channel, snapshot_date FROM fact_media_daily_stats))""",
        "required columns": """snapshot_date, channel, media_count, total_load_count, total_play_count,
            avg_engagement, engagement_event_count, unique_event_visitors, completion_rate, mobile_event_rate""",
        "allowed values: channel": _CHANNEL_OK,
        "numeric range: completion_rate": _SHARE.format("completion_rate"),
        "numeric range: avg_percent_viewed": _SHARE.format("avg_percent_viewed"),
    },
    "mart_geo_engagement": {
        "non-empty": "count(*) > 0",
        "required columns": """country, region, city, channel, engagement_event_count, unique_visitors,
            avg_percent_viewed, completion_rate""",
        "allowed values: channel": _CHANNEL_OK,
        "numeric range: completion_rate": _SHARE.format("completion_rate"),
        "numeric range: avg_percent_viewed": _SHARE.format("avg_percent_viewed"),
    },
    "mart_device_browser": {
        "non-empty": "count(*) > 0",
        "required columns": """platform, browser, is_mobile, channel, engagement_event_count, unique_visitors,
            avg_percent_viewed, completion_rate""",
        "allowed values: channel": _CHANNEL_OK,
        "numeric range: completion_rate": _SHARE.format("completion_rate"),
        "numeric range: avg_percent_viewed": _SHARE.format("avg_percent_viewed"),
    },
    "mart_visitor_engagement": {
        "non-empty": "count(*) > 0",
        "required columns": """visitor_key, event_count, avg_percent_viewed, max_percent_viewed,
            completed_event_count, completion_rate, engagement_segment, channels_seen, media_seen""",
        "unique: visitor_key": _ONCE.format("visitor_key", "mart_visitor_engagement"),
        "numeric range: completion_rate": _SHARE.format("completion_rate"),
        "numeric range: avg_percent_viewed": _SHARE.format("avg_percent_viewed"),
    },
}


def _layer_sql(layer: str, tables: tuple[str, ...]) -> str:
    """One row per check. A column that is missing makes the SQL fail."""
    rows = [f"SELECT '{layer} table exists: {t}' AS check_name, count(*) >= 0 AS passed FROM {t}" for t in tables]
    for t in tables:
        for name, holds in _CATALOGUE[t].items():
            holds = f"count(*) >= 0 AND count(({holds})) >= 0" if name == "required columns" else holds
            rows.append(f"SELECT '{t}: {name}' AS check_name, {holds} AS passed FROM {t}")
    return " UNION ALL ".join(rows)


def _expected_rows(lake) -> dict[str, int]:
    return quality.expected_row_counts(lake.config, lake.stats)


@query(_layer_sql("Gold", schemas.GOLD_TABLES))
def gold_checks(lake):
    tables = lake.write(schemas.GOLD_TABLES)
    found = quality.gold_checks(lake.spark, tables, CHANNELS, _expected_rows(lake))
    return found.select("check_name", "passed")


@query(_layer_sql("Mart", schemas.MART_TABLES))
def mart_checks(lake):
    tables = lake.write(schemas.MART_TABLES)
    found = quality.mart_checks(lake.spark, tables, CHANNELS, _expected_rows(lake))
    return found.select("check_name", "passed")


@query(f"""SELECT check_name, passed, count(*) FILTER (WHERE NOT passed) OVER () = 0 AS all_passed
    FROM ({_layer_sql('Gold', schemas.GOLD_TABLES)} UNION ALL
          {_layer_sql('Mart', schemas.MART_TABLES)})""")
def run_validation(lake):
    bases = [scratch_path(lake.spark, n) for n in ("gold", "marts")]
    for base, names in zip(bases, (schemas.GOLD_TABLES, schemas.MART_TABLES)):
        for name in names:
            write_table(lake[name], base, name)
    channels = lake.config.select("channel")
    passed, results = quality.run_validation(lake.spark, *bases, channels, _expected_rows(lake))
    rows = [(r["check_name"], r["passed"], passed) for r in results]  # one for each of the checks
    return lake.spark.createDataFrame(rows, "check_name STRING, passed BOOLEAN, all_passed BOOLEAN")
