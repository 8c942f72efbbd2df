"""Reading the given tables, and tables written once so that later steps start from them."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from engagement_lake.sources.session import scratch_path, settings
from engagement_lake.sources.tables import remove_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Bytes of an Arrow batch handed to Python; Spark's own limit lets thousands of long texts through.
BATCH_BYTES = 8 << 20
# Where the tables of ``written`` lie.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shuffles_dropped(spark: SparkSession):
    """Each query started inside deletes its shuffle files when it ends.

    Otherwise they lie on the executors' disks until the driver happens to collect its garbage, so that the
    shuffles of all steps add up. Results that are read again must be written.
    """
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from Parquet in the cluster's shared folder: lineage ends here, and so do the
    shuffles that led to it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark), settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=BATCH_BYTES):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def given_back(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` returned, once nothing will read them again.

    What was made of them must be written itself by then: a lost task of an unwritten result would look for
    the files. Any other DataFrame is left alone.
    """
    for table in tables:
        folder = _FOLDERS.pop(table, None)
        if folder is not None:
            remove_path(table.sparkSession, folder)


def free_name(columns: list[str], wish: str) -> str:
    """A column name that clashes with none of those given, whatever their case."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
