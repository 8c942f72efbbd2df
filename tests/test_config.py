import json

import pytest

from engagement_lake.sources.config import load_media_config, media_config

ITEMS = [
    {"media_id": "m1", "channel": "YouTube", "name": "First"},
    {"media_id": "m2", "channel": "Facebook", "name": "Second"},
]
YAML = """
media_ids:
  # the two reels
  - media_id: m1
    channel: YouTube
    name: First

  - media_id: m2
    channel: Facebook
    name: Second
"""


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


@pytest.mark.parametrize("name, text", [("c.yaml", YAML), ("c.json", json.dumps({"media_ids": ITEMS}))])
def test_config_from_file(spark, tmp_path, name, text):
    config = load_media_config(spark, write(tmp_path, name, text))
    assert config.columns == ["media_hashed_id", "channel", "configured_media_name"]
    assert sorted(map(tuple, config.collect())) == [
        ("m1", "YouTube", "First"), ("m2", "Facebook", "Second"),
    ]


def test_config_from_lines_tables_and_folders(spark, tmp_path):
    wanted = [("m1", "YouTube", "First"), ("m2", "Facebook", "Second")]

    def loaded(path):
        return sorted(map(tuple, load_media_config(spark, path).collect()))

    assert loaded(write(tmp_path, "c.jsonl", "\n".join(map(json.dumps, ITEMS)))) == wanted
    spark.createDataFrame(ITEMS, "media_id STRING, channel STRING, name STRING").write.parquet(f"{tmp_path}/c.parquet")
    assert loaded(f"{tmp_path}/c.parquet") == wanted
    (tmp_path / "yaml").mkdir()
    for item in ITEMS:
        write(tmp_path / "yaml", f"{item['media_id']}.yaml", json.dumps({"media_ids": [item]}))
    assert loaded(f"{tmp_path}/yaml") == wanted


def test_key_is_not_nullable_and_the_size_is_known(spark):
    config = media_config(spark, ITEMS)
    assert not config.schema["media_hashed_id"].nullable
    assert "LocalRelation" in config._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "items, message",
    [
        ([], "non-empty"),
        ([{"channel": "YouTube"}], "without media_id"),
        (ITEMS + ITEMS[:1], "repeats media_id"),
    ],
)
def test_bad_items_are_refused(spark, tmp_path, items, message):
    with pytest.raises(ValueError, match=message):
        media_config(spark, items)
    with pytest.raises(ValueError, match=message):
        load_media_config(spark, write(tmp_path, "c.json", json.dumps({"media_ids": items})))


@pytest.mark.parametrize("text", ["", "other: 1", "media_ids:", "media_ids: text", "- 1"])
def test_yaml_without_media_is_refused(spark, tmp_path, text):
    with pytest.raises(ValueError, match="non-empty"):
        load_media_config(spark, write(tmp_path, "c.yaml", text))


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_media_config(spark, str(tmp_path / "none.yaml"))
