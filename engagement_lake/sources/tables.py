"""Parquet tables of the lake, and the catalog entries over them."""

from __future__ import annotations

import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from engagement_lake.sources.schemas import TABLE_DDL, arrange


log = logging.getLogger(__name__)


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists, on whatever file system its scheme names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below the folder, on whatever file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]


def put_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file, and its folders, in one step."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def remove_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# The column that tables with snapshots are partitioned by, if they are.
SNAPSHOT = "snapshot_date"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table with its columns in order, also if a folder per snapshot holds it."""
    path = table_path(base, name)
    if name in TABLE_DDL and snapshots_of(spark, base, name):
        return arrange(spark.read.schema(TABLE_DDL[name]).parquet(path), name)
    return spark.read.parquet(path)


def snapshots_of(spark: SparkSession, base: str, name: str) -> list[str]:
    """The snapshots that have a folder of their own, oldest first; none if the table is one folder."""
    path = table_path(base, name)
    if not path_exists(spark, path):
        return []
    begin = f"{SNAPSHOT}="
    return sorted(n.removeprefix(begin) for n in child_names(spark, path) if n.startswith(begin))


def read_latest_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The rows of the newest snapshot. Folders tell which it is, and only its own is read; a table that is
    one folder is read for its greatest date first."""
    snapshots = [s for s in snapshots_of(spark, base, name) if s != _NO_SNAPSHOT]
    table = read_table(spark, base, name)
    return table.where(F.col(SNAPSHOT) == snapshots[-1]) if snapshots else latest_rows(table)


_NO_SNAPSHOT = "__HIVE_DEFAULT_PARTITION__"


def latest_rows(df: DataFrame) -> DataFrame:
    """Rows of the greatest snapshot date. The one date is known before the scan starts, so that it prunes
    the folders of a partitioned table."""
    newest = df.agg(F.max(SNAPSHOT)).scalar()
    return df.where(F.col(SNAPSHOT) == newest)


def footers(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table as a source that answers counts, and extremes of its numbers, from Parquet footers.

    Only aggregates without a filter are answered that way; all else is read as usual.
    """
    listed = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(listed)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(listed, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.parquet(table_path(base, name))
    finally:
        spark.conf.set(listed, before)


def find_table(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The table, or None if there is no such folder or nothing in it."""
    if not path_exists(spark, table_path(base, name)):
        return None
    try:
        return read_table(spark, base, name)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def write_table(
    df: DataFrame, base: str, name: str, mode: str = "overwrite", snapshots: bool = False
) -> int:
    """Write the table and return its row count, observed during the write itself.

    With ``snapshots``, every snapshot date has a folder of its own, and overwriting replaces only the
    snapshots that ``df`` holds.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    if snapshots:
        writer = writer.partitionBy(SNAPSHOT).option("partitionOverwriteMode", "dynamic")
    writer.parquet(table_path(base, name))
    rows = written.get["rows"]
    log.info("%s: %d rows -> %s", name, rows, table_path(base, name))
    return rows


def register_tables(spark: SparkSession, database: str, base: str, names: list[str]) -> None:
    """Expose written tables as external tables of a database; a suffix of a file's name is left out."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        table = f"{database}.{name.split('.')[0]}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=table_path(base, name), source="parquet")


def write_clustered(
    df: DataFrame, database: str, base: str, name: str, key: str, buckets: int, order: tuple[str, ...] = ()
) -> None:
    """Write the table as ``buckets`` sorted files by a hash of ``key``, and expose it in the catalog.

    Joins and groupings by the key, of tables with as many buckets, then shuffle nothing. All rows of one
    key share a bucket, so the key should be one that no value has a large part of the rows of.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key, *order)
        .option("path", table_path(base, name))
        .saveAsTable(f"{database}.{name}")
    )


def analyze_tables(spark: SparkSession, database: str, names: list[str]) -> None:
    """Let the catalog know rows, bytes and the values' extent of every column, for cost-based plans."""
    for name in names:
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_statistics(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count, distinct_count, min, max) of every analysed column.

    Distinct counts are estimates. One row per column: catalog entries, whatever the tables hold.
    """
    rows = []
    for table in spark.catalog.listTables(database):
        if table.tableType == "TEMPORARY":
            continue
        described = json.loads(spark.sql(f"DESCRIBE EXTENDED {database}.{table.name} AS JSON").head()[0])
        row_count = described.get("statistics", {}).get("num_rows")
        for column in spark.catalog.listColumns(f"{database}.{table.name}"):
            info = spark.sql(f"DESCRIBE EXTENDED {database}.{table.name} `{column.name}`").collect()
            known = {r["info_name"]: r["info_value"] for r in info if r["info_value"] != "NULL"}
            numbers = [int(known[n]) if n in known else None for n in ("num_nulls", "distinct_count")]
            rows.append((table.name, column.name, row_count, *numbers, known.get("min"), known.get("max")))
    return spark.createDataFrame(
        rows,
        "table_name STRING, column_name STRING, row_count BIGINT, null_count BIGINT, "
        "distinct_count BIGINT, min STRING, max STRING",
    )


def describe_tables(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name, data_type, position) of every table of a database."""
    rows = [
        (table.name, column.name, column.dataType, position)
        for table in spark.catalog.listTables(database)
        if table.tableType != "TEMPORARY"
        for position, column in enumerate(spark.catalog.listColumns(f"{database}.{table.name}"), 1)
    ]
    return spark.createDataFrame(
        rows, "table_name STRING, column_name STRING, data_type STRING, position INT"
    )
