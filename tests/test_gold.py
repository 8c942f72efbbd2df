import datetime as dt

from pyspark.sql import functions as F

from engagement_lake.plans import gold
from engagement_lake.plans import silver as silver_plans
from engagement_lake.sources.config import media_config
from engagement_lake.sources.schemas import column_types, columns_of

CONFIG = [
    {"media_id": "m1", "channel": "YouTube", "name": "First"},
    {"media_id": "m2", "channel": "Facebook", "name": "Second"},
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def event(key, day="2024-01-01", page=1, **values):
    return {"event_key": key, "ingest_date": day, "source_page": page, **values}


def test_earliest_landed_copy_of_an_event_survives(silver):
    events = silver("events", [
        event("e1", "2024-01-02", 1, city="late"),
        event("e1", "2024-01-01", 10, city="page ten"),
        event("e1", "2024-01-01", 2, city="page two"),
        event("e2", None, 1, city="undated"),
        event("e2", "2024-01-03", 1, city="dated"),
    ])
    assert rows(silver_plans.dedup_events(events), "event_key", "city") == [
        ("e1", "page two"), ("e2", "dated"),
    ]


def test_events_without_key_count_as_one(silver):
    events = silver("events", [event(None, visitor_key="a"), event(None, page=2, visitor_key="b")])
    assert rows(silver_plans.dedup_events(events), "visitor_key") == [("a",)]


def test_event_dedup_does_not_depend_on_partitioning(silver):
    events = silver("events", [event("e", city=c) for c in "abcdef"])
    kept = {
        rows(silver_plans.dedup_events(events.repartition(n)), "city")[0] for n in (1, 2, 5)
    }
    assert len(kept) == 1


def test_engagement_fact_keeps_unmapped_media_and_utc_dates(spark, silver):
    events = silver("events", [
        event("e1", media_hashed_id="m1", received_at="2024-01-31T23:30:00-02:00"),
        event("e2", media_hashed_id="m2", received_at="2024-01-31T23:30:00+02:00"),
        event("e3", media_hashed_id="other"),
        event("e4"),
        event("e1", page=2, media_hashed_id="m2"),
    ])
    fact = gold.build_fact_media_engagement(events, media_config(spark, CONFIG))
    assert fact.columns == columns_of("fact_media_engagement")
    assert rows(fact, "media_engagement_key", "channel", "event_date") == [
        ("e1", "YouTube", dt.date(2024, 2, 1)),
        ("e2", "Facebook", dt.date(2024, 1, 31)),
        ("e3", None, None),
        ("e4", None, None),
    ]


def test_unique_events_are_not_shuffled_again(spark, silver):
    events = silver("events", [event("e1", media_hashed_id="m1")])
    config = media_config(spark, CONFIG)
    plan = _plan(gold.build_fact_media_engagement(events, config, events_unique=True))
    assert "Exchange hashpartitioning" not in plan


def test_newest_metadata_wins_and_null_update_loses(spark, silver):
    metadata = silver("media_metadata", [
        {"media_hashed_id": "m1", "media_name": "old", "updated_at": "2024-01-01", "ingest_date": "2024-01-02"},
        {"media_hashed_id": "m1", "media_name": "undated", "updated_at": None, "ingest_date": "2024-01-09"},
        {"media_hashed_id": "m2", "media_name": None, "updated_at": "2024-01-01", "ingest_date": "2024-01-02"},
        {"media_hashed_id": "m2", "media_name": "re-landed earlier", "updated_at": "2024-01-01", "ingest_date": "2024-01-01"},
        {"media_hashed_id": "m3", "media_name": "unmapped"},
    ])
    media = gold.build_dim_media(metadata, media_config(spark, CONFIG))
    assert media.columns == columns_of("dim_media")
    assert rows(media, "media_key", "media_name", "channel") == [
        ("m1", "old", "YouTube"), ("m2", "Second", "Facebook"), ("m3", "unmapped", None),
    ]


def test_daily_stats_keep_the_last_file_and_drop_null_from_the_key(spark, silver):
    stats = silver("media_stats", [
        {"media_hashed_id": "m1", "ingest_date": "2024-01-01", "source_file": "a", "load_count": 1},
        {"media_hashed_id": "m1", "ingest_date": "2024-01-01", "source_file": "b", "load_count": 2},
        {"media_hashed_id": "m1", "ingest_date": None, "source_file": "a", "load_count": 3},
    ])
    facts = gold.build_fact_media_daily_stats(stats, media_config(spark, CONFIG))
    assert facts.columns == columns_of("fact_media_daily_stats")
    assert rows(facts, "media_daily_stats_key", "snapshot_date", "load_count") == [
        ("m1", None, 3), ("m1_2024-01-01", "2024-01-01", 2),
    ]


def test_visitor_takes_the_latest_known_value_of_each_attribute(silver):
    events = silver("events", [
        event("e1", visitor_key="v", received_at="2024-01-01", browser="Old", browser_version="1",
              platform="P", is_mobile=True, city="A", percent_viewed=0.5, media_hashed_id="m1"),
        event("e2", visitor_key="v", received_at="2024-01-03", browser=None, platform="Q", city="B",
              percent_viewed=None, media_hashed_id="m1"),
        event("e3", visitor_key="v", received_at="2024-01-02", browser="New", browser_version="2",
              platform="R", is_mobile=False, percent_viewed=1.0, media_hashed_id="m2"),
        event("e4", visitor_key="v", received_at=None, browser="Never", organization="Org",
              email="only@here"),
        event("e5", visitor_key=None, received_at="2024-01-05", browser="X"),
    ])
    visitors = gold.build_dim_visitor(events)
    assert visitors.columns == columns_of("dim_visitor")
    assert rows(
        visitors, "visitor_key_dim", "browser", "browser_version", "platform", "is_mobile", "city",
        "organization", "email", "event_count", "avg_percent_viewed", "max_percent_viewed",
        "media_count",
    ) == [
        ("v", "New", "2", "Q", False, "B", "Org", "only@here", 4, 0.75, 1.0, 2),
        (None, "X", None, None, None, None, None, None, 1, None, None, 0),
    ]


def test_events_of_one_instant_are_ordered_by_key(silver):
    events = silver("events", [
        event(k, visitor_key="v", received_at="2024-01-01", city=k) for k in ("e1", "e3", "e2")
    ])
    assert rows(gold.build_dim_visitor(events), "city") == [("e3",)]


def test_visitor_summary_only_fills_gaps(silver):
    events = silver("events", [
        event("e1", visitor_key="v", browser="Chrome", received_at="2024-01-01"),
        event("e2", visitor_key="w"),
        event("e3", visitor_key=None),
    ])
    summary = {"browser": "Edge", "platform": "Mac", "created_at": "2023-01-01",
               "last_active_at": "2023-02-01"}
    visitors = silver("visitors", [
        {"visitor_key": "v", "ingest_date": "2024-01-01", "visitor_email": "old", **summary},
        {"visitor_key": "v", "ingest_date": "2024-01-02", "visitor_email": "new", **summary},
        {"visitor_key": "w", "visitor_email": "w@x", **summary},
        {"visitor_key": None, "visitor_email": "nobody", **summary},
    ])
    found = gold.build_dim_visitor(events, visitors).withColumn("first", F.to_date("first_seen_at"))
    assert rows(found, "visitor_key", "email", "browser", "platform", "first") == [
        ("v", "new", "Chrome", "Mac", dt.date(2024, 1, 1)),
        ("w", "w@x", "Edge", "Mac", dt.date(2023, 1, 1)),
        (None, None, None, None, None),
    ]


def test_gold_types_follow_the_contract(spark, silver):
    tables = {
        "dim_media": gold.build_dim_media(
            silver("media_metadata", [{"media_hashed_id": "m1"}]), media_config(spark, CONFIG)),
        "fact_media_daily_stats": gold.build_fact_media_daily_stats(
            silver("media_stats", [{"media_hashed_id": "m1"}]), media_config(spark, CONFIG)),
        "fact_media_engagement": gold.build_fact_media_engagement(
            silver("events", [event("e")]), media_config(spark, CONFIG)),
        "dim_visitor": gold.build_dim_visitor(
            silver("events", [event("e")]), silver("visitors", [{"visitor_key": "v"}])),
    }
    for name, df in tables.items():
        expected = [(c, kind.lower()) for c, kind in column_types(name).items()]
        assert df.dtypes == expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_configuration_is_broadcast_and_a_large_one_is_not(spark, silver):
    events = silver("events", [event("e1", media_hashed_id="m1")])
    small = gold.build_fact_media_engagement(events, media_config(spark, CONFIG))
    assert "BroadcastHashJoin" in _plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
    try:
        large = gold.build_fact_media_engagement(events, media_config(spark, CONFIG))
        assert "SortMergeJoin" in _plan(large)
        assert rows(large, "event_key", "channel") == [("e1", "YouTube")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_limits_each_key_before_the_shuffle(silver):
    plan = _plan(silver_plans.dedup_events(silver("events", [event("e1")] * 2).repartition(3)))
    assert plan.count("WindowGroupLimit") == 2


def test_hot_keys_keep_one_row_each(spark):
    """A third of the rows are copies of one event, a third have no key."""
    copies = spark.range(30000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('e', id) END AS event_key",
        "IF(id % 3 = 0, CAST(30000 - id AS INT), 1) AS source_page", "'2024-01-01' AS ingest_date",
        "CAST(NULL AS STRING) AS source_file",
    )
    kept = silver_plans.dedup_events(copies.repartition(8))
    assert kept.count() == 10002
    assert kept.where("event_key = 'hot'").head()["source_page"] == 3
