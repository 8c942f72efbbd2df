from engagement_lake.plans import marts
from engagement_lake.sources.schemas import columns_of


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def view(key, channel="YouTube", visitor="v", viewed=0.5, **values):
    return {"event_key": key, "channel": channel, "visitor_key": visitor,
            "percent_viewed": viewed, **values}


def test_channel_mart_repeats_all_time_engagement_per_snapshot(silver):
    stats = silver("fact_media_daily_stats", [
        {"media_hashed_id": "m1", "channel": "YouTube", "snapshot_date": d, "load_count": n,
         "api_play_rate": r} for d, n, r in (("d1", 10, 0.2), ("d2", 20, 0.4))
    ] + [
        {"media_hashed_id": "m3", "channel": None, "snapshot_date": "d1", "load_count": 5},
        {"media_hashed_id": "m4", "channel": "Facebook", "snapshot_date": "d1"},
    ])
    engagement = silver("fact_media_engagement", [
        view("e1", viewed=0.95, is_mobile=True), view("e2", visitor="w", viewed=0.94),
        view("e3", visitor=None, viewed=None), view("e4", channel=None),
    ])
    media = silver("dim_media", [
        {"channel": "YouTube", "media_name": n} for n in ("b", "a", None)
    ] + [{"channel": None, "media_name": "z"}])
    mart = marts.build_mart_channel_performance(stats, engagement, media)
    assert mart.columns == columns_of("mart_channel_performance")
    assert rows(
        mart, "snapshot_date", "channel", "media_names", "total_load_count",
        "engagement_event_count", "unique_event_visitors", "completed_view_count",
        "completion_rate", "mobile_event_rate",
    ) == [
        ("d1", "Facebook", None, None, None, None, None, None, None),
        ("d1", "YouTube", "a | b", 10, 3, 2, 1, 1 / 3, 1 / 3),
        ("d1", None, None, 5, None, None, None, None, None),
        ("d2", "YouTube", "a | b", 20, 3, 2, 1, 1 / 3, 1 / 3),
    ]


def test_null_places_and_devices_are_groups(silver):
    engagement = silver("fact_media_engagement", [
        view("e1", country="A", received_at="2024-01-01"),
        view("e2", country="A", received_at="2024-01-03", viewed=1.0),
        view("e3"), view("e4", channel=None), view(None),
    ])
    geo = marts.build_mart_geo_engagement(engagement)
    assert geo.columns == columns_of("mart_geo_engagement")
    assert rows(geo, "country", "channel", "engagement_event_count", "completion_rate") == [
        ("A", "YouTube", 2, 0.5), (None, "YouTube", 1, 0.0), (None, None, 1, 0.0),
    ]
    device = marts.build_mart_device_browser(engagement)
    assert device.columns == columns_of("mart_device_browser")
    assert rows(device, "platform", "channel", "engagement_event_count") == [
        (None, "YouTube", 3), (None, None, 1),
    ]


def test_group_without_keyed_events_has_rate_zero(silver):
    geo = marts.build_mart_geo_engagement(silver("fact_media_engagement", [view(None, viewed=1.0)]))
    assert rows(geo, "engagement_event_count", "completed_view_count", "completion_rate") == [
        (0, 1, 0.0)
    ]


def test_visitor_mart(silver):
    visitors = silver("dim_visitor", [
        {"visitor_key": "v", "event_count": 3, "avg_percent_viewed": 0.5},
        {"visitor_key": "gone", "event_count": 2, "avg_percent_viewed": None},
        {"visitor_key": None, "event_count": 1, "avg_percent_viewed": 0.2},
    ])
    engagement = silver("fact_media_engagement", [
        view("e1", media_hashed_id="m2", viewed=1.0),
        view("e2", "Facebook", media_hashed_id="m1", viewed=0.95),
        view("e3", None, media_hashed_id="m1", viewed=0.1),
        view("e4", visitor=None, media_hashed_id="m9", viewed=1.0),
    ])
    mart = marts.build_mart_visitor_engagement(visitors, engagement)
    assert mart.columns == columns_of("mart_visitor_engagement")
    assert rows(
        mart, "visitor_key", "channels_seen", "media_seen", "completed_event_count",
        "completion_rate", "engagement_segment",
    ) == [
        ("gone", None, None, 0, 0.0, "76-100%"),
        ("v", "Facebook | YouTube", "m1 | m2", 2, 2 / 3, "26-50%"),
        (None, None, None, 0, 0.0, "0-25%"),
    ]


def test_visitor_of_unmapped_media_has_an_empty_channel_list(silver):
    visitors = silver("dim_visitor", [{"visitor_key": "v", "event_count": 1}])
    engagement = silver("fact_media_engagement", [view("e1", None, media_hashed_id="m9")])
    mart = marts.build_mart_visitor_engagement(visitors, engagement)
    assert rows(mart, "channels_seen", "media_seen") == [("", "m9")]


def test_one_hot_visitor_keeps_every_value(spark, silver):
    hot = spark.range(20000).selectExpr(
        "concat('e', id) AS event_key", "IF(id % 3 = 0, NULL, 'hot') AS visitor_key",
        "concat('m', id % 500) AS media_hashed_id", "'YouTube' AS channel",
        "1.0D AS percent_viewed",
    )
    visitors = silver("dim_visitor", [{"visitor_key": "hot", "event_count": 20000}])
    row = marts.build_mart_visitor_engagement(visitors, hot).head()
    assert len(row["media_seen"].split(" | ")) == 500
    assert row["completed_event_count"] == 20000 - 6667
