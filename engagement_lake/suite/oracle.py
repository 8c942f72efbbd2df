"""SQL over the same tables that computes what each registered query must return."""

from __future__ import annotations


def mean4(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / count({x})"


def mean9(x: str) -> str:
    return f"CAST(sum(CAST(floor({x} * 1e9) AS BIGINT)) AS DOUBLE) / 1e9 / count({x})"


def rate(numerator: str, denominator: str) -> str:
    return (
        f"CASE WHEN {denominator} IS NULL OR {denominator} = 0 THEN 0.0::DOUBLE "
        f"ELSE CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE) END"
    )


def latest(c: str) -> str:
    return f"arg_max({c}, row(received_at, event_key)) FILTER (WHERE {c} IS NOT NULL)"


def text_list(c: str) -> str:
    return f"coalesce(string_agg(DISTINCT {c}, ' | ' ORDER BY {c}), '')"


MEASURES = f"""count(event_key) AS engagement_event_count,
  count(DISTINCT visitor_key) AS {{visitors}},
  {mean4('percent_viewed')} AS avg_percent_viewed,
  max(percent_viewed) AS max_percent_viewed,
  count(*) FILTER (WHERE percent_viewed >= 0.95) AS completed_view_count"""

LATEST_COLUMNS = (
    "ip_address", "country", "region", "city", "latitude", "longitude", "organization", "email",
    "browser", "browser_version", "platform", "is_mobile", "ingest_date",
)

TABLES = f"""
WITH raw_ev AS (
  SELECT e.*, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events e
),
batches AS (
  SELECT '2024-01-31' AS ingest_date, 1 AS source_page, 1 AS every_n
  UNION ALL SELECT '2024-02-29', 2, 10
),
a_events AS (
  SELECT concat('e', CAST(event_id AS VARCHAR)) AS event_key,
    ts AS received_at,
    concat('v', CAST(user_id AS VARCHAR)) AS visitor_key,
    event_type AS media_hashed_id,
    concat(event_type, ' reel') AS media_name,
    concat('https://media.example/', event_type) AS media_url,
    least(value / CAST(100 AS DOUBLE), CAST(1 AS DOUBLE)) AS percent_viewed,
    CASE WHEN k % 7 <> 0
      THEN concat('10.', user_id % 200, '.0.', event_id % 200) END AS ip_address,
    n_name AS country, r_name AS region,
    concat('city', CAST(user_id % 7 AS VARCHAR)) AS city,
    CASE WHEN k % 7 <> 0 THEN CAST(user_id % 170 - 85 AS DOUBLE) END AS latitude,
    CASE WHEN k % 11 <> 0 THEN CAST(event_id % 350 - 175 AS DOUBLE) END AS longitude,
    CASE WHEN user_id % 4 = 0 THEN concat('org', CAST(user_id % 3 AS VARCHAR)) END AS organization,
    CASE WHEN event_id % 50 = 0
      THEN concat('u', CAST(user_id AS VARCHAR), '@example.org') END AS email,
    concat('https://site', user_id % 5, '.example') AS embed_url,
    CASE WHEN event_type IN ('purchase', 'signup') THEN event_type END AS conversion_type,
    CASE WHEN event_type IN ('purchase', 'signup') THEN props END AS conversion_data_json,
    concat('https://heat.example/', event_id) AS iframe_heatmap_url,
    CASE WHEN k % 10 = 9 THEN NULL WHEN k % 3 = 0 THEN 'Chrome'
         WHEN k % 3 = 1 THEN 'Safari' ELSE 'Firefox' END AS browser,
    CASE WHEN k % 10 = 9 THEN NULL ELSE CAST(k % 5 AS VARCHAR) END AS browser_version,
    CASE WHEN k % 10 = 9 THEN NULL WHEN k % 2 = 0 THEN 'Android' ELSE 'Mac' END AS platform,
    CASE WHEN k % 10 = 9 THEN NULL ELSE k % 2 = 0 END AS is_mobile,
    concat('https://cdn.example/', event_type) AS thumbnail_url,
    k + 200 AS thumbnail_width, k + 100 AS thumbnail_height,
    b.ingest_date, b.source_page
  FROM raw_ev
  JOIN nation ON n_nationkey = user_id % 25
  JOIN region ON r_regionkey = n_regionkey
  JOIN batches b ON event_id % b.every_n = 0
),
a_config AS (
  SELECT * FROM (VALUES ('view', 'YouTube', 'View reel'), ('click', 'YouTube', 'Click reel'),
    ('purchase', 'Facebook', 'Purchase reel'), ('signup', 'Facebook', 'Signup reel'))
  AS t(media_hashed_id, channel, configured_media_name)
),
a_metadata AS (
  SELECT n AS media_numeric_id, event_type AS media_hashed_id, 'Video' AS media_type,
    CASE WHEN event_type <> 'purchase' THEN concat(event_type, ' cut ', ingest_date) END AS media_name,
    duration_seconds, created_at,
    CASE WHEN NOT (event_type = 'click' AND ingest_date = '2024-02-29') THEN last_ts END AS updated_at,
    'ready' AS status, event_type = 'error' AS archived,
    concat('about ', event_type) AS description, n % 7 AS project_id,
    concat('p', n % 7) AS project_hashed_id, concat('project ', event_type) AS project_name,
    n % 5 AS section_id, concat('section ', event_type) AS section_name,
    concat('https://share.example/', event_type) AS share_url,
    concat('https://cdn.example/', event_type) AS thumbnail_url,
    640 AS thumbnail_width, 360 AS thumbnail_height,
    concat('f', ingest_date) AS source_file, ingest_date
  FROM (SELECT event_type, ingest_date, count(*) AS n, max(value) AS duration_seconds,
          min(ts) AS created_at, max(ts) AS last_ts
        FROM events JOIN batches b ON event_id % b.every_n = 0
        GROUP BY event_type, ingest_date)
),
a_stats_once AS (
  SELECT event_type AS media_hashed_id, count(*) AS load_count,
    count(*) FILTER (WHERE value >= 20) AS play_count,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(60 AS DOUBLE) AS hours_watched,
    count(DISTINCT user_id) AS visitor_count, d.ingest_date
  FROM events
  JOIN (SELECT '2024-01-10' AS ingest_date UNION ALL SELECT '2024-01-20'
        UNION ALL SELECT '2024-01-31') d ON CAST(ts AS DATE) <= CAST(d.ingest_date AS DATE)
  GROUP BY event_type, d.ingest_date
),
a_stats AS (SELECT *, 'f1' AS source_file FROM a_stats_once
  UNION ALL SELECT *, 'f2' AS source_file FROM a_stats_once),
a_visitors AS (
  SELECT concat('v', CAST(c_custkey AS VARCHAR)) AS visitor_key,
    CASE WHEN c_custkey % 3 = 0 THEN concat(c_name, '@example.com') END AS visitor_email,
    CASE WHEN b.ingest_date = '2024-02-29' THEN concat('NEW ', c_mktsegment)
         ELSE c_mktsegment END AS visitor_org_name,
    'Edge' AS browser, '1' AS browser_version, 'Windows' AS platform, FALSE AS is_mobile,
    b.ingest_date
  FROM customer
  JOIN (SELECT '2024-01-31' AS ingest_date, 1 AS every_n UNION ALL SELECT '2024-02-29', 4) b
    ON c_custkey % b.every_n = 0
),
known_visitors AS (
  SELECT * FROM a_visitors
  QUALIFY row_number() OVER (PARTITION BY visitor_key ORDER BY ingest_date DESC) = 1
),
ev AS (
  SELECT * FROM a_events
  QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY ingest_date, source_page) = 1
),
fact_media_engagement AS (
  SELECT event_key AS media_engagement_key, ev.*, CAST(received_at AS DATE) AS event_date, channel
  FROM ev LEFT JOIN a_config USING (media_hashed_id)
),
fact_media_daily_stats AS (
  SELECT concat_ws('_', s.media_hashed_id, s.ingest_date) AS media_daily_stats_key,
    s.media_hashed_id, channel, s.ingest_date AS snapshot_date, load_count, play_count,
    CAST(play_count AS DOUBLE) / CAST(load_count + 1 AS DOUBLE) AS api_play_rate,
    CAST(play_count AS DOUBLE) / CAST(load_count AS DOUBLE) AS calculated_play_rate,
    hours_watched, CAST(visitor_count AS DOUBLE) / CAST(load_count AS DOUBLE) AS engagement,
    visitor_count, s.ingest_date
  FROM (SELECT * FROM a_stats QUALIFY row_number() OVER (
          PARTITION BY media_hashed_id, ingest_date ORDER BY source_file DESC) = 1) s
  LEFT JOIN a_config c ON s.media_hashed_id = c.media_hashed_id
),
dim_media AS (
  SELECT m.media_hashed_id AS media_key, m.media_hashed_id, media_numeric_id, channel,
    coalesce(media_name, configured_media_name) AS media_name, media_type, duration_seconds,
    created_at, updated_at, status, archived, description, project_id, project_hashed_id,
    project_name, section_id, section_name, share_url, thumbnail_url, thumbnail_width,
    thumbnail_height, ingest_date
  FROM (SELECT * FROM a_metadata QUALIFY row_number() OVER (
          PARTITION BY media_hashed_id ORDER BY updated_at DESC NULLS LAST,
          ingest_date DESC NULLS LAST, source_file DESC NULLS LAST) = 1) m
  LEFT JOIN a_config c ON m.media_hashed_id = c.media_hashed_id
),
profiles AS (
  SELECT visitor_key, min(received_at) AS first_seen_at, max(received_at) AS last_seen_at,
    count(event_key) AS event_count, {mean4('percent_viewed')} AS avg_percent_viewed,
    max(percent_viewed) AS max_percent_viewed, count(DISTINCT media_hashed_id) AS media_count,
    {', '.join(f'{latest(c)} AS {c}' for c in LATEST_COLUMNS)}
  FROM ev GROUP BY visitor_key
),
dim_visitor AS (
  SELECT p.visitor_key AS visitor_key_dim, p.visitor_key, coalesce(email, visitor_email) AS email,
    ip_address, country, region, city, latitude, longitude,
    coalesce(organization, visitor_org_name) AS organization,
    coalesce(p.browser, v.browser) AS browser,
    coalesce(p.browser_version, v.browser_version) AS browser_version,
    coalesce(p.platform, v.platform) AS platform,
    coalesce(p.is_mobile, v.is_mobile) AS is_mobile, first_seen_at, last_seen_at, event_count,
    avg_percent_viewed, max_percent_viewed, media_count, p.ingest_date
  FROM profiles p LEFT JOIN known_visitors v ON p.visitor_key = v.visitor_key
),
stats_agg AS (
  SELECT snapshot_date, channel, count(DISTINCT media_hashed_id) AS media_count,
    CAST(sum(load_count) AS BIGINT) AS total_load_count,
    CAST(sum(play_count) AS BIGINT) AS total_play_count,
    avg(api_play_rate) AS avg_api_play_rate, avg(calculated_play_rate) AS avg_calculated_play_rate,
    sum(hours_watched) AS total_hours_watched, avg(engagement) AS avg_engagement,
    CAST(sum(visitor_count) AS BIGINT) AS total_visitor_count
  FROM fact_media_daily_stats GROUP BY snapshot_date, channel
),
engagement_agg AS (
  SELECT *, {rate('completed_view_count', 'engagement_event_count')} AS completion_rate,
    {rate('mobile_event_count', 'engagement_event_count')} AS mobile_event_rate
  FROM (SELECT channel, {MEASURES.format(visitors='unique_event_visitors')},
          count(*) FILTER (WHERE is_mobile) AS mobile_event_count
        FROM fact_media_engagement GROUP BY channel)
),
names AS (SELECT channel, {text_list('media_name')} AS media_names FROM dim_media GROUP BY channel),
mart_channel_performance AS (
  SELECT s.snapshot_date, s.channel, media_count, media_names, total_load_count,
    total_play_count, avg_api_play_rate, avg_calculated_play_rate, total_hours_watched,
    avg_engagement, total_visitor_count, engagement_event_count, unique_event_visitors,
    avg_percent_viewed, max_percent_viewed, completed_view_count, completion_rate,
    mobile_event_count, mobile_event_rate
  FROM stats_agg s LEFT JOIN engagement_agg e ON s.channel = e.channel
  LEFT JOIN names n ON s.channel = n.channel
),
mart_geo_engagement AS (
  SELECT *, {rate('completed_view_count', 'engagement_event_count')} AS completion_rate
  FROM (SELECT country, region, city, channel, {MEASURES.format(visitors='unique_visitors')},
          min(received_at) AS first_event_at, max(received_at) AS last_event_at
        FROM fact_media_engagement GROUP BY country, region, city, channel)
),
mart_device_browser AS (
  SELECT *, {rate('completed_view_count', 'engagement_event_count')} AS completion_rate
  FROM (SELECT platform, browser, browser_version, is_mobile, channel,
          {MEASURES.format(visitors='unique_visitors')},
          min(received_at) AS first_event_at, max(received_at) AS last_event_at
        FROM fact_media_engagement
        GROUP BY platform, browser, browser_version, is_mobile, channel)
),
viewing AS (
  SELECT visitor_key, {text_list('channel')} AS channels_seen,
    {text_list('media_hashed_id')} AS media_seen,
    count(*) FILTER (WHERE percent_viewed >= 0.95) AS completed_event_count
  FROM fact_media_engagement GROUP BY visitor_key
),
mart_visitor_engagement AS (
  SELECT *, {rate('completed_event_count', 'event_count')} AS completion_rate,
    CASE WHEN avg_percent_viewed <= 0.25 THEN '0-25%' WHEN avg_percent_viewed <= 0.5 THEN '26-50%'
         WHEN avg_percent_viewed <= 0.75 THEN '51-75%' ELSE '76-100%' END AS engagement_segment
  FROM (SELECT d.visitor_key, email, country, region, city, organization, browser,
          browser_version, platform, is_mobile, first_seen_at, last_seen_at, event_count,
          avg_percent_viewed, max_percent_viewed, media_count, channels_seen, media_seen,
          ingest_date, coalesce(completed_event_count, 0) AS completed_event_count
        FROM dim_visitor d LEFT JOIN viewing v ON d.visitor_key = v.visitor_key)
)
"""


_UNCONFIGURED = "('signup', 'Facebook', 'Signup reel')"


def over_tables(select: str, every_media: bool = False) -> str:
    """The select over the tables; ``every_media`` adds the media that is left unconfigured otherwise."""
    tables = TABLES
    if every_media:
        tables = tables.replace(_UNCONFIGURED, f"{_UNCONFIGURED}, ('error', 'YouTube', 'Error reel')")
    return f"{tables} {select}"


def _as_text(column: str, kind: str, micros: str) -> str:
    text = f"CAST({column} AS STRING)"
    if kind == "DOUBLE":
        # Steps of a millionth, cut where no short decimal number lies.
        text = f"CAST(CAST(floor({column} * 1000000 + 0.318309886) AS BIGINT) AS STRING)"
    elif kind == "TIMESTAMP":
        text = f"CAST({micros}({column}) AS STRING)"
    return f"coalesce({text}, '~')"


def row_text(columns: dict[str, str], micros: str) -> str:
    """SQL for all columns of a row as one text; ``micros`` names the engine's function of a time."""
    return "concat_ws('|', " + ", ".join(_as_text(c, k, micros) for c, k in columns.items()) + ")"


def contents(table: str, columns: dict[str, str]) -> str:
    """SELECT of a table's name, rows and a checksum of all rows of these columns."""
    part = f"CAST(concat('0x', substr(md5({row_text(columns, 'epoch_us')}), 1, 8)) AS BIGINT)"
    return f"""SELECT '{table}' AS table_name, count(*) AS row_count,
        CAST(sum({part}) AS BIGINT) AS checksum FROM {table}"""
