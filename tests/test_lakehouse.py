import json

import pytest

from engagement_lake.plans import reports
from engagement_lake.plans.gold import run_gold
from engagement_lake.plans.lakehouse import ValidationFailed, run_lakehouse
from engagement_lake.plans.marts import run_marts
from engagement_lake.plans.quality import run_validation
from engagement_lake.plans.silver import quarantine_counts
from engagement_lake.sources.session import scratch_path, shuffle_tasks_for
from engagement_lake.sources.tables import describe_tables, find_table, read_table, register_tables, write_table

CONFIG = {"media_ids": [
    {"media_id": "m1", "channel": "YouTube", "name": "First"},
    {"media_id": "m2", "channel": "Facebook", "name": "Second"},
]}


def put(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, indent=2))


def land(raw, extra_media=None, late_media=None):
    for media in ("m1", "m2", *([extra_media] if extra_media else [])):
        for day, plays in (("2024-01-01", 1), ("2024-01-02", 3)):
            if media == late_media and day == "2024-01-01":
                continue
            folder = f"media_id={media}/ingest_date={day}"
            put(raw / "media_metadata" / folder / "response.json",
                {"id": 1, "hashed_id": media, "name": f"{media} {day}", "updated": f"{day}T00:00:00Z",
                 "duration": 60.5, "status": "ready"})
            put(raw / "media_stats" / folder / "response.json",
                {"load_count": 10, "play_count": plays, "play_rate": plays / 10, "hours_watched": 1.5,
                 "engagement": 0.4, "visitors": plays})
            for page in (1, 2):
                put(raw / "events" / folder / f"page={page}.json", [
                    {"event_key": f"{media}-{n}", "received_at": f"{day}T0{n}:00:00Z", "visitor_key": f"v{n}",
                     "media_id": media, "percent_viewed": n / 4, "country": "US",
                     "user_agent_details": {"browser": "B", "browser_version": "1", "platform": "P", "mobile": n == 1}}
                    for n in range(page, page + 3)
                ])
    put(raw / "visitors/ingest_date=2024-01-02/response.json",
        {"visitors": [{"visitor_key": "v1", "visitor_identity": {"email": "v1@x"}}]})


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    land(base / "raw")
    put(base / "config.json", CONFIG)
    folders = {k: str(base / k) for k in ("raw", "silver", "gold", "marts")}
    written = run_lakehouse(spark, str(base / "config.json"), *folders.values())
    return folders, written


def test_every_table_is_written(lake):
    assert lake[1] == {
        "media_metadata": 4, "media_stats": 4, "visitors": 1, "events": 8,
        "dim_media": 2, "fact_media_daily_stats": 4, "fact_media_engagement": 8, "dim_visitor": 4,
        "mart_channel_performance": 4, "mart_geo_engagement": 2, "mart_device_browser": 4,
        "mart_visitor_engagement": 4,
    }


def test_events_come_from_the_first_day_and_page(spark, lake):
    events = read_table(spark, lake[0]["silver"], "events").collect()
    assert {(r["ingest_date"], r["source_page"]) for r in events if r["event_key"].endswith(("-1", "-2", "-3"))} == {("2024-01-01", 1)}
    assert {r["source_page"] for r in events if r["event_key"].endswith("-4")} == {2}


def test_every_report_runs_on_the_written_tables(spark, lake):
    folders = lake[0]
    found = {n: reports.run_report(spark, folders["gold"], folders["marts"], n).collect() for n in reports.REPORTS}
    assert all(found.values())
    assert [(r["snapshot_date"], r["channel"], r["total_play_count"]) for r in found["latest_channel_performance"]] == [
        ("2024-01-02", "Facebook", 3), ("2024-01-02", "YouTube", 3),
    ]
    assert found["duplicate_event_keys"][0]["duplicate_event_key_count"] == 0
    assert [r["snapshot_date"] for r in found["channel_history"]] == ["2024-01-01"] * 2 + ["2024-01-02"] * 2
    assert found["latest_snapshot_count"][0].asDict() == {
        "table_name": "mart_channel_performance_latest", "row_count": 2,
    }


def test_unmapped_media_fail_the_run(spark, tmp_path):
    land(tmp_path / "raw", "m3")
    put(tmp_path / "config.json", CONFIG)
    folders = [str(tmp_path / k) for k in ("raw", "silver", "gold", "marts")]
    with pytest.raises(ValidationFailed, match="allowed values: channel"):
        run_lakehouse(spark, str(tmp_path / "config.json"), *folders)
    assert run_lakehouse(spark, str(tmp_path / "config.json"), *folders, validate=False)["dim_media"] == 3


def test_a_broken_page_is_put_aside_and_fails_the_run(spark, tmp_path):
    land(tmp_path / "raw")
    put(tmp_path / "config.json", CONFIG)
    broken = tmp_path / "raw/events/media_id=m1/ingest_date=2024-01-02"
    (broken / "page=3.json").write_text("<html>\nlimit reached")
    put(broken / "page=4.json", {"error": "limit"})
    put(broken / "page=5.json", [{"event_key": "m1-9", "visitor_key": "v9", "percent_viewed": 1}, {"oops": [1]}, 7])
    folders = [str(tmp_path / k) for k in ("raw", "silver", "gold", "marts")]
    with pytest.raises(ValidationFailed, match="quarantine is empty: events"):
        run_lakehouse(spark, str(tmp_path / "config.json"), *folders)
    assert read_table(spark, folders[1], "events").where("event_key = 'm1-9'").count() == 1
    assert read_table(spark, folders[1], "events").where("event_key IS NULL").count() == 0
    aside = read_table(spark, folders[1], "quarantine/events").collect()
    assert sorted((r["source_page"], r["source_media_id"], r["ingest_date"]) for r in aside) == [
        (3, "m1", "2024-01-02"), (4, "m1", "2024-01-02"), (5, "m1", "2024-01-02"), (5, "m1", "2024-01-02"),
    ]
    assert {r["record_text"] for r in aside if r["source_page"] == 3} == {"<html>\nlimit reached"}
    counts = {r["endpoint"]: (r["malformed_rows"], r["files"]) for r in quarantine_counts(spark, folders[1]).collect()}
    assert counts == {"events": (4, 3), "media_metadata": (0, 0), "media_stats": (0, 0), "visitors": (0, 0)}
    for page in (3, 4, 5):
        (broken / f"page={page}.json").unlink()
    assert run_lakehouse(spark, str(tmp_path / "config.json"), *folders)["events"] == 8


def test_a_media_may_begin_later(spark, tmp_path):
    land(tmp_path / "raw", late_media="m2")
    put(tmp_path / "config.json", CONFIG)
    folders = [str(tmp_path / k) for k in ("raw", "silver", "gold", "marts")]
    written = run_lakehouse(spark, str(tmp_path / "config.json"), *folders)
    assert (written["fact_media_daily_stats"], written["mart_channel_performance"]) == (3, 3)


def test_chosen_tables_only(spark, lake, tmp_path):
    folders = lake[0]
    config = str(tmp_path / "config.json")
    put(tmp_path / "config.json", CONFIG)
    gold = str(tmp_path / "gold")
    assert run_gold(spark, folders["silver"], gold, config, ["dim_media"]) == {"dim_media": 2}
    assert find_table(spark, gold, "dim_visitor") is None
    with pytest.raises(ValueError, match="unknown gold tables"):
        run_gold(spark, folders["silver"], gold, config, ["dim_time"])
    with pytest.raises(ValueError, match="unknown marts"):
        run_marts(spark, gold, gold, ["mart_time"])


def test_validation_reports_absent_layers(spark, tmp_path, caplog):
    caplog.set_level("INFO", "engagement_lake")
    passed, results = run_validation(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["YouTube"])
    assert not passed and len(results) == 8
    assert "checks: 8, passed: 0, failed: 8" in caplog.text


def test_gold_does_not_need_visitors(spark, lake, tmp_path):
    folders = lake[0]
    for name in ("media_metadata", "media_stats", "events"):
        write_table(read_table(spark, folders["silver"], name), str(tmp_path / "silver"), name)
    put(tmp_path / "config.json", CONFIG)
    written = run_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "config.json"), ["dim_visitor"])
    assert written == {"dim_visitor": 4}


def test_catalog(spark, lake):
    folders = lake[0]
    for _ in range(2):
        register_tables(spark, "lake_gold", folders["gold"], ["dim_media", "dim_visitor"])
    assert spark.sql("SELECT count(*) FROM lake_gold.dim_visitor").head()[0] == 4
    described = describe_tables(spark, "lake_gold").where("position = 1").collect()
    assert sorted((r["table_name"], r["column_name"], r["data_type"]) for r in described) == [
        ("dim_media", "media_key", "string"), ("dim_visitor", "visitor_key_dim", "string"),
    ]
    assert "lake_gold" in {r["namespace"] for r in spark.sql("SHOW DATABASES").collect()}
    assert {r["tableName"] for r in spark.sql("SHOW TABLES IN lake_gold").collect()} == {"dim_media", "dim_visitor"}


def test_paths_and_sizes(spark, tmp_path):
    assert write_table(spark.range(3), f"{tmp_path}//", "t") == 3
    assert write_table(spark.range(2), str(tmp_path), "t", mode="append") == 2
    assert read_table(spark, f"{tmp_path}/", "t").count() == 5
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shuffle_tasks_for(1) == 200
    assert shuffle_tasks_for(1 << 40) == 4096
    assert shuffle_tasks_for(100 << 40) == 409_600


def test_another_session_zone_is_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            run_gold(spark, str(tmp_path), str(tmp_path), "none")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
