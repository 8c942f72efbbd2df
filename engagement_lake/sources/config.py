"""Media configuration: which media belong to which channel."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.sources.tables import path_exists

_COLUMNS = pa.schema(
    [
        pa.field("media_hashed_id", pa.string(), nullable=False),
        pa.field("channel", pa.string()),
        pa.field("configured_media_name", pa.string()),
    ]
)


def media_config(spark: SparkSession, items: Iterable[Mapping]) -> DataFrame:
    """Configuration frame from ``{media_id, channel, name}`` items.

    Built from Arrow, so that Catalyst knows its exact size: below the broadcast threshold the
    channel joins broadcast it, above they become sort-merge joins.
    """
    items = list(items)
    if not items:
        raise ValueError("media configuration needs a non-empty media_ids list")
    nameless = [item for item in items if not item.get("media_id")]
    if nameless:
        raise ValueError(f"media configuration item without media_id: {nameless[0]}")
    ids = [str(item["media_id"]) for item in items]
    repeated = sorted(i for i, n in Counter(ids).items() if n > 1)
    if repeated:
        raise ValueError(f"media configuration repeats media_id: {repeated}")
    columns = [ids, [i.get("channel") for i in items], [i.get("name") for i in items]]
    return spark.createDataFrame(
        pa.table([pa.array(c, pa.string()) for c in columns], schema=_COLUMNS)
    )


_ITEM = "media_id STRING, channel STRING, name STRING"


def _checked(items: DataFrame) -> DataFrame:
    """Configuration frame from (media_id, channel, name) rows, which must be there, named and unique."""
    config = items.selectExpr(
        "media_id AS media_hashed_id", "channel", "name AS configured_media_name"
    )
    counts = config.agg(
        F.count(F.lit(1)).alias("items"),
        F.count("media_hashed_id").alias("ids"),
        F.count_distinct("media_hashed_id").alias("distinct_ids"),
    ).head()
    if counts["items"] == 0:
        raise ValueError("media configuration needs a non-empty media_ids list")
    if counts["ids"] < counts["items"]:
        raise ValueError("media configuration item without media_id")
    if counts["distinct_ids"] < counts["ids"]:
        raise ValueError("media configuration repeats media_id")
    return config


def _yaml_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items of whole YAML documents."""
    import yaml

    for batch in batches:
        for text in batch.column("value").to_pylist():
            parsed = yaml.safe_load(text)
            items = parsed.get("media_ids") if isinstance(parsed, dict) else None
            items = items if isinstance(items, list) else []
            columns = [
                pa.array([None if i.get(n) in (None, "") else str(i[n]) for i in items], pa.string())
                for n in ("media_id", "channel", "name")
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["media_id", "channel", "name"])


def load_media_config(spark: SparkSession, path: str) -> DataFrame:
    """Read the configuration from any Hadoop path, a file or a folder of files of one form.

    Documents with a ``media_ids`` list are YAML or (``*.json``) JSON, each parsed by one task. Large
    configurations should come as one item a line (``*.jsonl``) or as a table (``*.parquet``) with
    the columns media_id, channel and name, which are split.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"media configuration not found: {path}")
    if path.endswith(".parquet"):
        items = spark.read.parquet(path)
    elif path.endswith(".jsonl"):
        items = spark.read.schema(_ITEM).json(path)
    elif path.endswith(".json"):
        schema = f"media_ids ARRAY<STRUCT<{_ITEM.replace(' STRING', ': STRING')}>>"
        items = spark.read.schema(schema).option("multiLine", True).json(path)
        items = items.selectExpr("inline(media_ids)")
    else:
        try:
            import yaml  # noqa: F401
        except ImportError as error:
            raise ImportError("YAML configuration needs PyYAML; JSON works without it") from error
        items = spark.read.text(path, wholetext=True).mapInArrow(_yaml_items, _ITEM)
    return _checked(items)
