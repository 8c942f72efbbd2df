"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# One shuffle task should get about this much input, and a written file come to about as much.
SHUFFLE_TASK_BYTES = 256 << 20
# A writing task keeps files of so many folders open.
OPEN_FOLDERS = 64
# A scan of well compressed files is cut into at least so many tasks per core, as far as there are files.
TASKS_PER_CORE = 4


def shuffle_tasks_for(input_bytes: int) -> int:
    return max(200, -(-input_bytes // SHUFFLE_TASK_BYTES))


def build_session(app_name: str, input_bytes: int | None = None, **settings: str) -> SparkSession:
    """Get or create a session in UTC with adaptive execution.

    ``input_bytes`` is the volume of the largest shuffled input: it sizes the initial number of
    shuffle tasks, which adaptive execution then merges where they turn out small. Raw page
    files are small, so a low open cost lets one task read hundreds of them.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TASK_BYTES),
        "spark.sql.files.openCostInBytes": str(512 << 10),
        "spark.sql.cbo.enabled": "true",
        "spark.sql.cbo.joinReorder.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    if input_bytes is not None:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_tasks_for(input_bytes))
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Event dates are calendar days in UTC; any other session zone would move them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


@contextmanager
def settings(spark: SparkSession, **values: int | str) -> Iterator[None]:
    """Settings of the session, two underscores for a dot, that hold for the jobs started inside."""
    named = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    try:
        for name, value in named.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scan_tasks(spark: SparkSession, least: int | None = None):
    """Scans by the jobs inside have at least so many tasks (``TASKS_PER_CORE`` without a number).

    Bytes say little about the rows of compressed files: a split of the usual size can hold more than
    a task sorts in memory, and there can be fewer splits than cores.
    """
    least = spark.sparkContext.defaultParallelism * TASKS_PER_CORE if least is None else least
    return settings(spark, spark__sql__files__minPartitionNum=max(1, least))


def unsorted_folders(spark: SparkSession):
    """Writes by folder keep the files of up to ``OPEN_FOLDERS`` folders a task open.

    Otherwise each task sorts its rows by folder first, and spills what is more than its memory. A task
    that meets more folders sorts the rest.
    """
    return settings(spark, spark__sql__maxConcurrentOutputFileWriters=OPEN_FOLDERS)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    A folder of this machine is used only on a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="engagement_lake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
