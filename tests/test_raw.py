import json

import pytest
from pyspark.sql import functions as F

from engagement_lake.plans import silver
from engagement_lake.sources import raw, session
from engagement_lake.sources.raw import land_raw_json, lines_of, scan_raw_json, with_path_metadata
from engagement_lake.sources.schemas import RAW_DDL, column_types
from engagement_lake.sources.tables import read_table

DAY = "ingest_date=2024-01-01"


def put(base, path, payload):
    target = base / path
    target.parent.mkdir(parents=True, exist_ok=True)
    text = payload if isinstance(payload, str) else json.dumps(payload, indent=2)
    target.write_text(text, encoding="utf-8")


def flat(spark, base, endpoint):
    raw = with_path_metadata(scan_raw_json(spark, str(base), endpoint))
    return silver.FLATTEN[endpoint](raw)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_path_metadata(spark, tmp_path):
    put(tmp_path, f"events/media_id=m1/{DAY}/page=12.json", [{"event_key": "a"}, {"event_key": "b"}])
    put(tmp_path, "events/odd.json", [{"event_key": "c"}])
    found = flat(spark, tmp_path, "events")
    assert rows(found, "event_key", "source_media_id", "ingest_date", "source_page") == [
        ("a", "m1", "2024-01-01", 12), ("b", "m1", "2024-01-01", 12), ("c", None, None, None),
    ]
    assert found.where("silver_processed_at IS NULL OR source_file IS NULL").isEmpty()


def test_ingest_date_stays_text(spark, tmp_path):
    put(tmp_path, f"media_stats/media_id=m1/{DAY}/response.json", {"load_count": 1})
    assert dict(flat(spark, tmp_path, "media_stats").dtypes)["ingest_date"] == "string"


def test_media_metadata(spark, tmp_path):
    put(tmp_path, f"media_metadata/media_id=m1/{DAY}/response.json", {
        "id": 5, "hashed_id": "m1", "type": "Video", "name": "One", "duration": "12.5",
        "created": "2024-01-01T00:00:00+00:00", "updated": "nope", "archived": False,
        "project": {"id": 9, "hashed_id": "p", "name": "P"}, "section": {"id": 3, "name": "S"},
        "thumbnail": {"url": "u", "width": 200, "height": "120"}, "unknown": 1,
    })
    put(tmp_path, f"media_metadata/media_id=m2/{DAY}/response.json", {"hashed_id": "m2", "section": "T"})
    put(tmp_path, f"media_metadata/media_id=m3/{DAY}/response.json", {"hashed_id": "m3"})
    found = flat(spark, tmp_path, "media_metadata")
    assert found.columns == list(column_types("media_metadata"))
    assert rows(
        found, "media_hashed_id", "media_numeric_id", "duration_seconds", "archived",
        "project_name", "section_id", "section_name", "thumbnail_width", "thumbnail_height",
        F.col("updated_at").isNull(),
    ) == [
        ("m1", 5, 12.5, False, "P", 3, "S", 200, 120, True),
        ("m2", None, None, None, None, None, "T", None, None, True),
        ("m3", None, None, None, None, None, None, None, None, True),
    ]


def test_media_stats(spark, tmp_path):
    for media, payload in {
        "zero": {"load_count": 0, "play_count": 0},
        "unknown": {"play_count": 4},
        "noplays": {"load_count": 4},
        "fine": {"load_count": 4, "play_count": 1, "play_rate": 0.2, "visitors": 3, "hours_watched": 1},
    }.items():
        put(tmp_path, f"media_stats/media_id={media}/{DAY}/response.json", payload)
    assert rows(
        flat(spark, tmp_path, "media_stats"), "media_hashed_id", "calculated_play_rate",
        "api_play_rate", "visitor_count", "hours_watched",
    ) == [
        ("fine", 0.25, 0.2, 3, 1.0), ("noplays", None, None, None, None),
        ("unknown", None, None, None, None), ("zero", None, None, None, None),
    ]


def test_visitors_listed_or_wrapped(spark, tmp_path):
    person = {"visitor_key": "a", "visitor_identity": {"name": "N", "email": "e", "org": {"name": "O"}},
              "user_agent_details": {"browser": "B", "mobile": True}}
    put(tmp_path, "visitors/ingest_date=2024-01-01/response.json", [person, {"visitor_key": "b"}])
    put(tmp_path, "visitors/ingest_date=2024-01-02/response.json",
        {"visitors": [{"visitor_key": "c", "load_count": "7"}]})
    put(tmp_path, "visitors/ingest_date=2024-01-03/response.json", {"error": "none today"})
    put(tmp_path, "visitors/ingest_date=2024-01-04/response.json", {"visitors": []})
    assert rows(
        flat(spark, tmp_path, "visitors"), "visitor_key", "visitor_name", "visitor_org_name",
        "is_mobile", "load_count", "ingest_date",
    ) == [
        ("a", "N", "O", True, None, "2024-01-01"), ("b", None, None, None, None, "2024-01-01"),
        ("c", None, None, None, 7, "2024-01-02"),
    ]


def test_events(spark, tmp_path):
    put(tmp_path, f"events/media_id=m1/{DAY}/page=1.json", [
        {"event_key": "a", "percent_viewed": "0.5", "received_at": "nope", "media_id": "m1",
         "conversion_data": {"z": 1, "a": "x"}, "user_agent_details": None, "lat": 1.5},
        {"event_key": "b", "percent_viewed": "abc", "conversion_data": None},
    ])
    assert rows(
        flat(spark, tmp_path, "events"), "event_key", "percent_viewed", "conversion_data_json",
        "browser", "latitude", F.col("received_at").isNull(),
    ) == [("a", 0.5, '{"a":"x","z":1}', None, 1.5, True), ("b", None, None, None, None, True)]


def test_payload_that_is_no_event_list_is_reported(spark, tmp_path):
    put(tmp_path, f"events/media_id=m1/{DAY}/page=1.json", [{"event_key": "a"}, {"visitor_key": "v"}])
    put(tmp_path, f"events/media_id=m1/{DAY}/page=2.json", {"error": "limit reached"})
    bad = silver.malformed_event_rows(scan_raw_json(spark, str(tmp_path), "events")).collect()
    assert [(r["source_file"].rsplit("/", 1)[1], r["malformed_rows"]) for r in bad] == [("page=2.json", 1)]


def test_missing_or_empty_endpoints_are_skipped(spark, tmp_path, caplog):
    caplog.set_level("INFO", "engagement_lake")
    raw, out = tmp_path / "raw", str(tmp_path / "silver")
    (raw / "media_stats").mkdir(parents=True)
    put(raw, "visitors/ingest_date=2024-01-01/response.json", "[]")
    put(raw, f"events/media_id=m1/{DAY}/page=1.json", [{"event_key": "a"}, {"event_key": "a"}])
    assert silver.run_silver(spark, str(raw), out) == {"events": 1}
    shown = caplog.text
    for endpoint in ("media_metadata", "media_stats", "visitors"):
        assert f"{endpoint}: skipped" in shown
    assert read_table(spark, out, "events").count() == 1


def test_unknown_endpoint_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown endpoints"):
        silver.run_silver(spark, str(tmp_path), str(tmp_path), ["comments"])


def test_landed_lines_and_documents_are_read_together(spark, tmp_path):
    put(tmp_path, f"events/media_id=m1/{DAY}/page=1.json", [{"event_key": "a"}, {"event_key": "b"}])
    landed = spark.createDataFrame([("a", "m1", 3), ("c", "m2", 4)], "event_key STRING, media STRING, n INT")
    land_raw_json(
        landed, str(tmp_path), "events", F.lit("2024-01-02"), F.col("media"), F.col("n"), ["event_key"]
    )
    assert rows(
        flat(spark, tmp_path, "events"), "event_key", "source_media_id", "ingest_date", "source_page"
    ) == [
        ("a", "m1", "2024-01-01", 1), ("a", "m1", "2024-01-02", 3), ("b", "m1", "2024-01-01", 1),
        ("c", "m2", "2024-01-02", 4),
    ]


def test_landing_appends_and_keeps_unknown_media_null(spark, tmp_path):
    one = spark.createDataFrame([("v", None)], "visitor_key STRING, media STRING")
    for _ in range(2):
        land_raw_json(one, str(tmp_path), "visitors", F.lit("2024-01-01"), F.col("media"), payload=["visitor_key"])
    raw = with_path_metadata(scan_raw_json(spark, str(tmp_path), "visitors"))
    assert rows(raw, "visitor_key", "source_media_id") == [("v", None), ("v", None)]


def test_events_are_landed_with_their_page(spark, tmp_path):
    with pytest.raises(ValueError, match="page"):
        land_raw_json(spark.range(1), str(tmp_path), "events")


def test_raw_schemas_name_every_field_once():
    assert set(RAW_DDL) == {"media_metadata", "media_stats", "visitors", "events"}


def test_no_record_vanishes_whatever_the_file_is_called(spark, tmp_path):
    import gzip

    lines = "".join(json.dumps({"event_key": k}) + "\n" for k in "abcde")
    names = ["part-0.jsonl", "lines.json", "page=2.ndjson", "page=1", "odd.log", "landed.txt"]
    for n in names:
        put(tmp_path, f"events/media_id=m1/{DAY}/{n}", lines)
    for n in ("packed.json.gz", "packed.jsonl.gz"):
        (tmp_path / f"events/media_id=m1/{DAY}/{n}").write_bytes(gzip.compress(lines.encode()))
    put(tmp_path, f"events/media_id=m1/{DAY}/document", [{"event_key": "f"}, {"event_key": "g"}])
    put(tmp_path, f"events/media_id=m1/{DAY}/one.json", '\n  [{"event_key": "h"}]\n')
    put(tmp_path, f"events/media_id=m1/{DAY}/none.json", "[]")
    put(tmp_path, f"events/media_id=m1/{DAY}/blank.json", " \n")
    put(tmp_path, f"events/media_id=m1/{DAY}/broken.json", '[{"event_key": "i"')
    found = scan_raw_json(spark, str(tmp_path), "events")
    keys = sorted(str(r[0]) for r in found.select("event_key").collect())
    assert keys == sorted([*"abcde"] * 8 + ["f", "g", "h", "None"])
    bad = silver.malformed_event_rows(found).collect()
    assert [r["source_file"].rsplit("/", 1)[1] for r in bad] == ["broken.json"]


def test_layout_can_be_given(spark, tmp_path):
    put(tmp_path, "events/x", '{"event_key": "a"}\n{"event_key": "b"}\n')
    assert scan_raw_json(spark, str(tmp_path), "events", "lines").count() == 2
    put(tmp_path, "visitors/x.txt", [{"visitor_key": "a"}, {"visitor_key": "b"}, {"visitor_key": "c"}])
    assert scan_raw_json(spark, str(tmp_path), "visitors", "documents").count() == 3
    with pytest.raises(ValueError, match="unknown layout"):
        scan_raw_json(spark, str(tmp_path), "events", "csv")


def test_media_ids_survive_the_path(spark, tmp_path):
    ids = ["a b:c", "50%", "x=y", "p+q", "a%20b", "\u00e9\u4e2d", "s/t", "plain"]
    stats = spark.createDataFrame([(i, 1) for i in ids], "media STRING, load_count INT")
    land_raw_json(
        stats, str(tmp_path), "media_stats", F.lit("2024-01-01"), F.col("media"), payload=["load_count"]
    )
    assert rows(flat(spark, tmp_path, "media_stats"), "media_hashed_id") == sorted([(i,) for i in ids], key=repr)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def events_of(n, start=0):
    odd = ['plain', 'a } b', '[{"x": 1}, {', 'quote " and \\\\ back', '},{', 'é 中', '\\n', '']
    return [
        {"event_key": f"e{i}", "city": odd[i % len(odd)] + "x" * (i % 50), "conversion_data": {"k": [i, {"z": odd[i % 5]}]}}
        for i in range(start, start + n)
    ]


def expected_of(records):
    return sorted((r["event_key"], r["city"], json.dumps(r["conversion_data"], sort_keys=True)) for r in records)


def found_of(df):
    found = df.select("event_key", "city", "conversion_data").collect()
    return sorted((r[0], r[1], json.dumps(json.loads(r[2]), sort_keys=True)) for r in found)


def test_large_files_are_cut_at_their_records(spark, tmp_path, small_splits):
    folder = f"events/media_id=m1/{DAY}"
    lines, pretty, inline, small = (events_of(300, start) for start in (0, 1000, 2000, 3000))
    put(tmp_path, f"{folder}/lines.json", "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in lines))
    put(tmp_path, f"{folder}/pretty.json", "\n\n" + json.dumps(pretty, indent=3))
    put(tmp_path, f"{folder}/inline.json", "[ " + "},\n{".join(json.dumps(r)[1:-1] for r in inline).join("{}") + " ]")
    put(tmp_path, f"{folder}/small.json", json.dumps(small[:3]))
    put(tmp_path, f"{folder}/object.json", {**pretty[0], "event_key": "alone", "media_url": "\n" * 9000})
    put(tmp_path, f"{folder}/named.jsonl", "".join(json.dumps(r) + "\n" for r in events_of(200, 5000)))
    found = scan_raw_json(spark, str(tmp_path), "events")
    alone = {**pretty[0], "event_key": "alone"}
    assert found_of(found) == expected_of([*lines, *pretty, *inline, *small[:3], alone, *events_of(200, 5000)])
    read = lines_of(spark, [str(tmp_path / "events")]).where("source_file LIKE '%lines.json'")
    assert read.select(F.spark_partition_id()).distinct().count() > 5
    assert read.groupBy(F.spark_partition_id()).agg(F.sum(F.length("value")).alias("n")).where("n > 8192").count() == 0


def test_large_documents_with_a_given_layout(spark, tmp_path, small_splits):
    records = events_of(200)
    put(tmp_path, "events/x.txt", json.dumps(records, indent=1))
    assert found_of(scan_raw_json(spark, str(tmp_path), "events", "documents")) == expected_of(records)


def test_a_large_file_that_is_no_json_stays_one_malformed_row(spark, tmp_path, small_splits):
    put(tmp_path, "events/x.json", "<html>\n" + "no record { here ]\n" * 1000)
    assert scan_raw_json(spark, str(tmp_path), "events").where("event_key IS NULL").count() == 1


def test_landing_a_batch_again_changes_nothing(spark, tmp_path):
    rows_in = spark.createDataFrame([("a", "m1"), ("b", "m2")], "event_key STRING, media STRING")

    def land(df, batch):
        return land_raw_json(df, str(tmp_path), "events", F.lit("2024-01-02"), F.col("media"), F.lit(1), ["event_key"], batch)

    land(rows_in, "one")
    land(rows_in, "one")
    land(rows_in.withColumn("event_key", F.lit("c")), "two")
    assert rows(flat(spark, tmp_path, "events"), "event_key", "source_media_id", "ingest_date") == [
        ("a", "m1", "2024-01-02"), ("b", "m2", "2024-01-02"), ("c", "m1", "2024-01-02"), ("c", "m2", "2024-01-02"),
    ]
    with pytest.raises(ValueError, match="not a name"):
        land(rows_in, "a/b")


def test_an_unfinished_batch_is_not_read_and_is_replaced(spark, tmp_path):
    rows_in = spark.createDataFrame([("a", "m1")], "event_key STRING, media STRING")

    def land(batch=None):
        land_raw_json(rows_in, str(tmp_path), "events", F.lit("2024-01-02"), F.col("media"), F.lit(1), ["event_key"], batch)

    put(tmp_path, "events/batch=one/media_id=m1/ingest_date=2024-01-02/part.txt", json.dumps({"event_key": "half"}))
    assert scan_raw_json(spark, str(tmp_path), "events") is None
    land()  # records without a batch are read beside
    assert rows(flat(spark, tmp_path, "events"), "event_key") == [("a",)]
    land("one")
    assert rows(flat(spark, tmp_path, "events"), "event_key") == [("a",), ("a",)]


def test_landed_lines_are_small_files_of_few_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "COMPRESSED", {**raw.COMPRESSED, "maxRecordsPerFile": 400})
    records = spark.range(4000).selectExpr("CAST(id AS STRING) AS event_key", "concat('m', id % 3) AS media_id")
    land_raw_json(records, str(tmp_path), "events", F.lit("2024-01-02"), F.col("media_id"), F.lit(1))
    files = list((tmp_path / "events").rglob("part-*"))
    assert len(files) >= 10 and all(f.name.endswith(".txt.gz") for f in files)
    text = sum(len(json.dumps({"event_key": str(n), "media_id": "m1", "_page": "1"})) for n in range(4000))
    assert sum(f.stat().st_size for f in files) < text / 3
    found = flat(spark, tmp_path, "events")
    assert found.groupBy("source_file").count().where("count > 400").isEmpty()
    assert rows(found.groupBy("source_media_id").count(), "source_media_id", "count") == [
        ("m0", 1334), ("m1", 1333), ("m2", 1333),
    ]


def sorts(spark, df, path):
    """Whether writing by folder sorts the rows, as its plan says."""
    df.createOrReplaceTempView("written_by_folder")
    spark.sql(f"CREATE TABLE IF NOT EXISTS by_folder (n BIGINT, folder STRING) USING parquet PARTITIONED BY (folder) LOCATION '{path}'")
    plan = spark.sql("EXPLAIN FORMATTED INSERT OVERWRITE by_folder SELECT n, folder FROM written_by_folder").head()[0]
    return "Sort" in plan


def test_writes_by_folder_do_not_sort(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS n", "concat('f', id % 70) AS folder").coalesce(1)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    assert sorts(spark, df, tmp_path / "table")
    with session.unsorted_folders(spark):
        assert not sorts(spark, df, tmp_path / "table")
        df.write.partitionBy("folder").parquet(str(tmp_path / "many"))  # more folders than are kept open
    assert spark.conf.get(name) == before
    assert spark.read.parquet(str(tmp_path / "many")).agg(F.sum("n")).head()[0] == 4950


def test_staged_files_and_the_tasks_that_read_them_hold_few_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(silver, "STAGED_ROWS", 50)
    put(tmp_path, f"events/media_id=m1/{DAY}/page=1.json", [{"event_key": f"e{n}"} for n in range(500)])
    staged = silver.stage_raw(spark, str(tmp_path), "events")
    assert (staged.good_rows, staged.malformed_rows) == (500, 0)
    of_file = staged.good.groupBy(F.input_file_name()).count()
    assert of_file.count() == 10 and of_file.where("count > 50").isEmpty()
    name = "spark.sql.files.minPartitionNum"
    with session.scan_tasks(spark, 10), session.settings(spark, spark__sql__files__openCostInBytes=1024):
        assert spark.conf.get(name) == "10"
        assert staged.good.groupBy(F.spark_partition_id()).count().where("count > 50").isEmpty()
    assert spark.conf.get(name, None) is None
