"""The raw zone: JSON landed per endpoint, media and ingest date."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engagement_lake.functions import to_int
from engagement_lake.sources.schemas import RAW_DDL
from engagement_lake.sources.session import unsorted_folders
from engagement_lake.sources.tables import child_names, path_exists, put_marker, table_path

# How a path spells the media, the ingest date and the page it belongs to.
MEDIA_IN_PATH = r"media_id=([^/]+)"
DATE_IN_PATH = r"ingest_date=([^/]+)"
PAGE_IN_PATH = r"page=(\d+)\.json"

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Files that are known to hold one record per line.
_RECORD_LINES = r"\.(txt|jsonl|ndjson)[^/]*$"

LAYOUTS = ("lines", "documents")

# How landed lines are written: records repeat their field names, so they shrink to a fraction at any level.
# Such files are not split on read, so none may hold many records.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 250_000}

_BATCH = "batch="
_COMMITTED = "_committed"
# What batches may be called: a name that every file system keeps as it is.
_BATCH_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def scan_raw_json(
    spark: SparkSession, base: str, endpoint: str, layout: str | None = None, with_value: bool = False
) -> DataFrame | None:
    """All records of all files below ``base/endpoint`` with their ``source_file``; None if absent.

    ``layout`` says what every file holds: ``lines`` (one JSON value per line) or ``documents`` (one
    JSON value). Without it, files named ``*.txt*``, ``*.jsonl*`` or ``*.ndjson*`` are lines, and every
    other file, whatever its name, is lines if its first line is a whole JSON value and else a
    document. A value is a record or an array of records; one that is no JSON gives a row without
    any field, never none. ``with_value`` adds the text of the value that a record came in as ``_value``.

    Files of at most one split (``spark.sql.files.maxPartitionBytes``) that are not known to be lines are
    read whole. Larger ones are cut: lines at their ends, documents between the records of their array,
    so that no task and no string holds a large file. Of a document that is one object, the object is
    one record. Batches that were landed without being committed are not read.
    """
    if layout is not None and layout not in LAYOUTS:
        raise ValueError(f"unknown layout: {layout}")
    path = table_path(base, endpoint)
    if not path_exists(spark, path):
        return None
    paths = _committed_paths(spark, base, endpoint)
    if not paths:
        return None
    values = _values(spark, paths, layout)
    return _records(values, endpoint, with_value)


def _committed_paths(spark: SparkSession, base: str, endpoint: str) -> list[str]:
    """The endpoint's folder, or, where batches lie in it, what is committed and what has no batch."""
    path = table_path(base, endpoint)
    names = child_names(spark, path)
    if not any(n.startswith(_BATCH) for n in names):
        return [path]
    markers = table_path(base, f"{_COMMITTED}/{endpoint}")
    committed = set(child_names(spark, markers)) if path_exists(spark, markers) else set()
    read = [n for n in names if not n.startswith(_BATCH) or n.removeprefix(_BATCH) in committed]
    return [f"{path}/{n}" for n in read if not n.startswith(("_", "."))]


def split_bytes(spark: SparkSession) -> int:
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def _values(spark: SparkSession, paths: list[str], layout: str | None) -> DataFrame:
    """(source_file, value): the text of every JSON value."""
    source_file = F.col("_metadata.file_path").alias("source_file")

    def reader():
        return spark.read.option("recursiveFileLookup", True)

    if layout == "lines":
        return reader().text(paths).select(source_file, "value")
    limit = split_bytes(spark)
    named = F.col("_metadata.file_path").rlike(_RECORD_LINES)
    cut = ~named if layout is None else F.lit(True)
    small = F.col("_metadata.file_size") <= limit
    whole = reader().text(paths, wholetext=True)
    whole = whole.where(cut & small).select("value", source_file)
    if layout == "documents":
        values = whole.select("source_file", "value")
    else:
        text = F.regexp_replace("value", r"^\s+", "")
        first_line = F.substring_index(text, "\n", 1)
        each = F.when(F.try_parse_json(first_line).isNotNull(), F.split("value", "\n"))
        values = whole.select("source_file", F.explode(F.coalesce(each, F.array("value"))).alias("value"))
        values = values.unionByName(reader().text(paths).where(named).select(source_file, "value"))
    sizes = reader().format("binaryFile").load(paths)
    large = sizes.where(F.col("length") > limit).select("path")
    large = large if layout == "documents" else large.where(~F.col("path").rlike(_RECORD_LINES))
    if large.isEmpty():
        return values
    numbered = lines_of(spark, paths, cut & ~small)
    return values.unionByName(cut_files(numbered, layout))


def lines_of(spark: SparkSession, paths: list[str], keep: Column | None = None) -> DataFrame:
    """(source_file, block, at, value): every line; ``at`` orders the lines of a block, ``block`` the blocks of a file."""
    read = spark.read.option("recursiveFileLookup", True).text(paths)
    read = read if keep is None else read.where(keep)
    return read.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def cut_files(lines: DataFrame, layout: str | None = None) -> DataFrame:
    """(source_file, value) of files that are too large to be read whole."""
    begins = lines.where((F.col("block") == 0) & F.col("value").rlike(r"\S"))
    first = begins.groupBy("source_file").agg(F.min_by("value", "at").alias("first"))
    is_lines = F.try_parse_json("first").isNotNull() if layout is None else F.lit(False)
    kinds = first.select("source_file", is_lines.alias("is_lines"), F.col("first").rlike(r"^\s*\[").alias("is_array"))
    # One row per file: joined, not gathered.
    known = lines.join(kinds, "source_file", "left").withColumn("is_lines", F.coalesce("is_lines", F.lit(True)))
    by_line = known.where("is_lines").select("source_file", "value")
    return by_line.unionByName(_document_records(known.where("NOT is_lines")))


# Strings, marks of structure, and what lies between. Strings hold no line ends, so each line can be cut alone.
_TOKENS = r'"(?:[^"\\]++|\\.)*+"|[\[\]{},]|[^"\[\]{},]++|"'


def _document_records(lines: DataFrame) -> DataFrame:
    """(source_file, value): the elements of each document's array, or the whole object.

    How deep a place lies in the document follows from the marks before it: added up within each block,
    then over the blocks of a file. Commas at depth one part the records.
    """
    tokens = F.regexp_extract_all("value", F.lit(_TOKENS), F.lit(0))
    cut = lines.select("source_file", "is_array", "block", "at", F.posexplode(tokens).alias("pos", "token"))
    step = F.when(F.col("token").isin("[", "{"), 1).when(F.col("token").isin("]", "}"), -1).otherwise(0)
    deep = _running(cut.withColumn("step", step), "step", "depth")
    parts = F.col("is_array") & (F.col("token") == ",") & (F.col("depth") == 1)
    counted = _running(deep.withColumn("parts", parts.cast("int")), "parts", "record")
    outside = F.col("is_array") & ((F.col("depth") == 0) | ((F.col("depth") == 1) & (F.col("step") == 1)))
    inside = counted.where(~(outside & (F.col("step") != 0)) & (F.col("parts") == 0))
    # Grouped by record: no more than one record's tokens meet.
    ordered = F.array_sort(F.collect_list(F.struct("block", "at", "pos", "token")))
    records = inside.groupBy("source_file", "record").agg(ordered.alias("tokens"))
    return records.select("source_file", F.array_join(F.col("tokens.token"), "").alias("value"))


def _running(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the running sum of a column over each file, in the order of its blocks, lines and tokens."""
    block = Window.partitionBy("source_file", "block").orderBy("at", "pos")
    file = Window.partitionBy("source_file").orderBy("block")
    sums = df.groupBy("source_file", "block").agg(F.sum(column).alias("_sum"))
    before = sums.select("source_file", "block", (F.sum("_sum").over(file) - F.col("_sum")).alias("_before"))
    within = df.withColumn("_within", F.sum(column).over(block.rowsBetween(Window.unboundedPreceding, 0)))
    added = within.join(before, ["source_file", "block"])
    return added.withColumn(name, F.col("_within") + F.col("_before")).drop("_within", "_before")


def _records(values: DataFrame, endpoint: str, with_value: bool = False) -> DataFrame:
    """The records of JSON values."""
    values = values.where(r"value RLIKE '\\S'")
    record = f"STRUCT<{RAW_DDL[endpoint]}>"
    parsed = F.from_json("value", f"ARRAY<{record}>")
    # One element that is no object spoils the whole array: then each is read alone.
    elements = F.transform(F.from_json("value", "ARRAY<STRING>"), lambda e: F.from_json(e, record))
    # Text that is no JSON stays as a row; an empty array has no records.
    parsed = F.coalesce(parsed, elements, F.array(F.lit(None)))
    kept = [F.col("value").alias("_value")] if with_value else []
    return values.select("source_file", *kept, F.explode(parsed).alias("record")).select(
        "record.*", "source_file", *(["_value"] if with_value else [])
    )


def _path_part(pattern: str) -> Column:
    """The part as it was given: percent signs of the URI undone, then those of the folder name."""
    part = F.regexp_extract("source_file", pattern, 1)
    part = F.when(~part.isin("", _NULL_PARTITION), part)
    for _ in range(2):
        # A plus sign stands for itself here; a folder that was never escaped stays as it is.
        part = F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)
    return part


def with_path_metadata(df: DataFrame) -> DataFrame:
    """Add what the path tells (media, ingest date, page) and the processing time."""
    return df.withColumns(
        {
            "source_media_id": _path_part(MEDIA_IN_PATH),
            "ingest_date": _path_part(DATE_IN_PATH),
            "source_page": to_int(_path_part(PAGE_IN_PATH)),
            "silver_processed_at": F.current_timestamp(),
        }
    )


def today() -> Column:
    """Default ingest date, as ISO text (UTC session)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def land_raw_json(
    records: DataFrame,
    base: str,
    endpoint: str,
    ingest_date: Column | None = None,
    media_id: Column | None = None,
    page: Column | None = None,
    payload: list[str] | None = None,
    batch: str | None = None,
) -> str:
    """Append records as compressed JSON lines below ``endpoint/[media_id=../]ingest_date=../``.

    With a ``batch``, landing may be repeated: its files lie below ``endpoint/batch=../`` and count from the
    moment a marker says that all are there. A batch that is committed is not landed again; one that
    was left unfinished is replaced. Two landings of one batch must not run at once.

    The payload is every column of ``records``, or those named. The page of an event goes into the payload
    too: a folder per page would mean one file per hundred events. The rebalance hint gathers a
    media's rows into few files and splits a media that holds much of the data.
    """
    if endpoint == "events" and page is None:
        raise ValueError("events need a page")
    fields = [F.col(c) for c in (records.columns if payload is None else payload)]
    if page is not None:
        fields.append(page.cast("string").alias("_page"))
    folders = {"ingest_date": today() if ingest_date is None else ingest_date}
    if media_id is not None:
        folders = {"media_id": media_id, **folders}
    lines = records.select(
        F.to_json(F.struct(*fields)).alias("value"),
        *[c.cast("string").alias(name) for name, c in folders.items()],
    )
    path, mode, marker = table_path(base, endpoint), "append", None
    if batch is not None:
        if not _BATCH_NAME.fullmatch(batch):
            raise ValueError(f"not a name for a batch: {batch}")
        marker = table_path(base, f"{_COMMITTED}/{endpoint}/{batch}")
        path, mode = f"{path}/{_BATCH}{batch}", "overwrite"
        if path_exists(lines.sparkSession, marker):
            return path
    with unsorted_folders(lines.sparkSession):
        (
            lines.hint("rebalance", *folders)
            .write.mode(mode)
            .partitionBy(*folders)
            .options(**COMPRESSED)
            .text(path)
        )
    if marker is not None:
        put_marker(lines.sparkSession, marker)
    return path
