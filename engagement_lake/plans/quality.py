"""Data-quality checks.

A check is a (passed, message) pair computed from measures of one table. All checks of a table share
one scan: rows are taken apart into (column, value) pairs for the columns that have to be unique or to
hold allowed values, counted by value in the map tasks before anything is shuffled, and all other
measures travel beside them, one row a task.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.operators.distinct import Total, column_values, merged_totals, rows_total
from engagement_lake.plans.silver import quarantine_counts
from engagement_lake.sources.schemas import ENDPOINTS, GOLD_TABLES, MART_TABLES
from engagement_lake.sources.tables import find_table, table_path

log = logging.getLogger(__name__)

RESULT_DDL = "check_no INT, check_name STRING, passed BOOLEAN, message STRING"

# The name of each check.
NAMES = {
    "exists": "{layer} table exists: {table}",
    "non_empty": "{table}: non-empty",
    "row_count": "{table}: expected row count",
    "column": "{table}: column exists: {column}",
    "required": "{table}: required columns",
    "no_nulls": "{table}: no nulls: {column}",
    "unique": "{table}: unique: {column}",
    "allowed": "{table}: allowed values: {column}",
    "range": "{table}: numeric range: {column}",
    "quarantine": "Silver quarantine is empty: {table}",
}
# What a check measured: "%s" stands for the measured values.
MESSAGES = {
    "exists": "looked for at {where}",
    "non_empty": "rows: %s",
    "row_count": "rows: %s; wanted: {expected}",
    "column": "the table has {columns}",
    "required_found": "none missing",
    "required_missing": "missing: {columns}",
    "no_column": "no column {column} to check",
    "no_nulls": "rows without a value: %s",
    "unique": "rows beyond the first of their value: %s",
    "allowed": "rows without a value: %s; rows with another value: %s; other values: %s",
    "range": "from %s to %s; rows below: %s; rows above: %s",
    "no_number": "no row holds a number",
    "quarantine": "malformed rows: %s; files: %s",
}


@dataclass(frozen=True)
class Check:
    """``passed`` and ``message`` are expressions over the named ``totals`` of the table's rows and over what
    is measured of the values of the column ``by_value``: ``repeated_<column>``, ``null_rows_<column>``
    and, with ``allowed``, ``other_rows_<column>`` and ``other_values_<column>``."""

    name: str
    passed: Column
    message: Column
    totals: Mapping[str, Total] = field(default_factory=dict)
    by_value: str | None = None
    allowed: DataFrame | tuple[str, ...] | None = None


def _message(key: str, *measured: Column, **known) -> Column:
    template = MESSAGES[key].format(**{k: str(v).replace("%", "%%") for k, v in known.items()})
    return F.format_string(template, *measured)


def _on_column(key: str, df: DataFrame, table: str, column: str, build) -> Check:
    """``build(name)``, or the failed check if the table lacks the column."""
    name = NAMES[key].format(table=table, column=column)
    if column in df.columns:
        return build(name)
    return Check(name, F.lit(False), _message("no_column", column=column))


def _rows() -> dict[str, Total]:
    return {"rows": rows_total()}


def _nulls(column: str) -> dict[str, Total]:
    return {f"nulls_{column}": Total("count", F.col(column).isNull())}


def non_empty(df: DataFrame, table: str) -> Check:
    name, rows = NAMES["non_empty"].format(table=table), F.col("rows")
    return Check(name, rows > 0, _message("non_empty", rows, table=table), _rows())


def row_count(df: DataFrame, table: str, expected: int) -> Check:
    name, rows = NAMES["row_count"].format(table=table), F.col("rows")
    return Check(name, rows == expected, _message("row_count", rows, expected=expected), _rows())


def column_exists(df: DataFrame, table: str, column: str) -> Check:
    name = NAMES["column"].format(table=table, column=column)
    return Check(name, F.lit(column in df.columns), _message("column", columns=df.columns))


def required_columns(df: DataFrame, table: str, columns: Iterable[str]) -> Check:
    missing = [c for c in columns if c not in df.columns]
    message = _message("required_missing" if missing else "required_found", columns=missing)
    return Check(NAMES["required"].format(table=table), F.lit(not missing), message)


def no_nulls(df: DataFrame, table: str, column: str) -> Check:
    nulls = F.col(f"nulls_{column}")
    message = _message("no_nulls", nulls, column=column)
    return _on_column(
        "no_nulls", df, table, column, lambda n: Check(n, nulls == 0, message, _nulls(column))
    )


def unique(df: DataFrame, table: str, column: str) -> Check:
    """Every row beyond the first of its value is a duplicate; NULL is a value."""
    duplicates = F.col(f"repeated_{column}")
    message = _message("unique", duplicates, column=column)
    return _on_column(
        "unique", df, table, column, lambda n: Check(n, duplicates == 0, message, by_value=column)
    )


def value_counts(df: DataFrame, column: str, allowed: DataFrame | Iterable[str]) -> DataFrame:
    """(value, rows, allowed) of every value of the column. NULL is a value that is not allowed.

    ``allowed`` is a frame of one column, or values.
    """
    counted = df.groupBy(F.col(column).cast("string").alias("value"))
    counted = counted.agg(F.count(F.lit(1)).alias("rows"))
    known = _known_values(df, allowed).withColumn("known", F.lit(True))
    found = counted.join(known, "value", "left")
    return found.select("value", "rows", F.coalesce("known", F.lit(False)).alias("allowed"))


def unexpected_values(df: DataFrame, column: str, allowed: DataFrame | Iterable[str]) -> DataFrame:
    """(value, rows) of every value that is not allowed, all of them."""
    return value_counts(df, column, allowed).where("NOT allowed").drop("allowed")


def allowed_values(df: DataFrame, table: str, column: str, allowed: DataFrame | Iterable[str]) -> Check:
    """NULL is not allowed. The message counts; ``unexpected_values`` lists."""
    nulls, rows, values = (F.col(f"{n}_{column}") for n in ("null_rows", "other_rows", "other_values"))
    allowed = allowed if isinstance(allowed, DataFrame) else tuple(allowed)

    def build(name: str) -> Check:
        message = _message("allowed", nulls, rows, values)
        return Check(name, (rows == 0) & (nulls == 0), message, by_value=column, allowed=allowed)

    return _on_column("allowed", df, table, column, build)


def numeric_range(df: DataFrame, table: str, column: str, low: float, high: float) -> Check:
    """Inclusive; NULL and text that is no number are ignored, but some number has to be there."""
    smallest, largest = F.col(f"min_{column}"), F.col(f"max_{column}")
    below, above = F.col(f"below_{column}"), F.col(f"above_{column}")

    def build(name: str) -> Check:
        number = F.col(column).try_cast("double")
        number = F.when(~F.isnan(number), number)
        observed = _message("range", smallest, largest, below, above, column=column)
        return Check(
            name,
            smallest.isNotNull() & (below == 0) & (above == 0),
            F.when(smallest.isNull(), _message("no_number", column=column)).otherwise(observed),
            {
                f"min_{column}": Total("min", number),
                f"max_{column}": Total("max", number),
                f"below_{column}": Total("count", number < low),
                f"above_{column}": Total("count", number > high),
            },
        )

    return _on_column("range", df, table, column, build)


def evaluate(df: DataFrame, checks: Iterable[Check], first_no: int = 0) -> DataFrame:
    """(check_no, check_name, passed, message), one row per check of this table, from one scan."""
    numbered = list(enumerate(checks, first_no))
    results = F.array(
        *[
            F.struct(
                F.lit(n).alias("check_no"),
                F.lit(check.name).alias("check_name"),
                F.coalesce(check.passed, F.lit(False)).alias("passed"),
                check.message.alias("message"),
            )
            for n, check in numbered
        ]
    )
    return _measured(df, [check for _, check in numbered]).select(F.inline(results))


def _measured(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row with all that the checks are computed from."""
    totals = {a: t for check in checks for a, t in check.totals.items()} or _rows()
    columns = list(dict.fromkeys(check.by_value for check in checks if check.by_value))
    if not columns:
        rows = df.select(*[t.value.alias(a) for a, t in totals.items()])
        return rows.agg(*[t.over_rows(F.col(a)).alias(a) for a, t in totals.items()])

    values = column_values(df, columns, totals)
    known = [
        _known_values(df, check.allowed).withColumn("column_no", F.lit(columns.index(check.by_value)))
        for check in checks
        if check.allowed is not None
    ]
    if known:
        known = reduce(DataFrame.unionByName, known).withColumn("known", F.lit(True))
        values = values.join(known, ["column_no", "value"], "left")
    else:
        values = values.withColumn("known", F.lit(None).cast("boolean"))
    measures = []
    for number, column in enumerate(columns):
        own = F.col("column_no") == number
        null, other = own & F.col("value").isNull(), own & F.col("value").isNotNull() & F.col("known").isNull()
        measures += [
            F.coalesce(F.sum(F.when(own, F.col("value_rows") - 1)), F.lit(0)).alias(f"repeated_{column}"),
            F.coalesce(F.sum(F.when(null, F.col("value_rows"))), F.lit(0)).alias(f"null_rows_{column}"),
            F.coalesce(F.sum(F.when(other, F.col("value_rows"))), F.lit(0)).alias(f"other_rows_{column}"),
            F.count_if(other).alias(f"other_values_{column}"),
        ]
    return values.agg(*merged_totals(totals), *measures)


def _known_values(df: DataFrame, allowed: DataFrame | Iterable[str]) -> DataFrame:
    """(value) of the allowed values, each once, as text and without NULL."""
    if not isinstance(allowed, DataFrame):
        allowed = df.sparkSession.createDataFrame([(v,) for v in allowed], "value STRING")
    known = allowed.toDF("value").select(F.col("value").cast("string").alias("value"))
    return known.where("value IS NOT NULL").distinct()


@dataclass(frozen=True)
class TableRules:
    required: tuple[str, ...]
    keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    has_channel: bool = True
    shares: tuple[str, ...] = ()


# Which columns each table must have, which are keys (no NULL, unique), which may
# not be NULL or repeated, and which are shares between 0 and 1.
RULES = {
    "dim_media": TableRules(
        required=(
            "media_key",
            "media_hashed_id",
            "channel",
            "media_name",
            "duration_seconds",
            "status",
            "ingest_date",
        ),
        keys=("media_hashed_id",),
    ),
    "dim_visitor": TableRules(
        required=(
            "visitor_key",
            "first_seen_at",
            "last_seen_at",
            "event_count",
            "avg_percent_viewed",
            "media_count",
            "ingest_date",
        ),
        keys=("visitor_key",),
        has_channel=False,
        shares=("avg_percent_viewed", "max_percent_viewed"),
    ),
    "fact_media_daily_stats": TableRules(
        required=(
            "media_daily_stats_key",
            "media_hashed_id",
            "channel",
            "snapshot_date",
            "load_count",
            "play_count",
            "hours_watched",
            "engagement",
            "visitor_count",
        ),
        keys=("media_daily_stats_key",),
    ),
    "fact_media_engagement": TableRules(
        required=(
            "media_engagement_key",
            "event_key",
            "received_at",
            "event_date",
            "media_hashed_id",
            "channel",
            "visitor_key",
            "percent_viewed",
            "ingest_date",
        ),
        keys=("event_key",),
        not_null=("media_hashed_id", "channel", "visitor_key"),
        shares=("percent_viewed",),
    ),
    "mart_channel_performance": TableRules(
        required=(
            "snapshot_date",
            "channel",
            "media_count",
            "total_load_count",
            "total_play_count",
            "avg_engagement",
            "engagement_event_count",
            "unique_event_visitors",
            "completion_rate",
            "mobile_event_rate",
        ),
        shares=("completion_rate", "avg_percent_viewed"),
    ),
    "mart_geo_engagement": TableRules(
        required=(
            "country",
            "region",
            "city",
            "channel",
            "engagement_event_count",
            "unique_visitors",
            "avg_percent_viewed",
            "completion_rate",
        ),
        shares=("completion_rate", "avg_percent_viewed"),
    ),
    "mart_device_browser": TableRules(
        required=(
            "platform",
            "browser",
            "is_mobile",
            "channel",
            "engagement_event_count",
            "unique_visitors",
            "avg_percent_viewed",
            "completion_rate",
        ),
        shares=("completion_rate", "avg_percent_viewed"),
    ),
    "mart_visitor_engagement": TableRules(
        required=(
            "visitor_key",
            "event_count",
            "avg_percent_viewed",
            "max_percent_viewed",
            "completed_event_count",
            "completion_rate",
            "engagement_segment",
            "channels_seen",
            "media_seen",
        ),
        unique=("visitor_key",),
        has_channel=False,
        shares=("completion_rate", "avg_percent_viewed"),
    ),
}


def table_checks(
    df: DataFrame, table: str, channels: DataFrame | Iterable[str], expected_rows: int | None = None
) -> list[Check]:
    """The checks of one table, without the one that it exists."""
    rules = RULES[table]
    checks = [non_empty(df, table)]
    if expected_rows is not None:
        checks.append(row_count(df, table, expected_rows))
    checks.append(required_columns(df, table, rules.required))
    for key in rules.keys:
        checks += [no_nulls(df, table, key), unique(df, table, key)]
    checks += [no_nulls(df, table, c) for c in rules.not_null]
    checks += [unique(df, table, c) for c in rules.unique]
    if rules.has_channel:
        checks.append(allowed_values(df, table, "channel", channels))
    checks += [numeric_range(df, table, c, 0.0, 1.0) for c in rules.shares]
    return checks


def layer_checks(
    spark: SparkSession,
    layer: str,
    tables: Mapping[str, DataFrame | None],
    channels: DataFrame | Iterable[str],
    expected_rows: Mapping[str, int] | None = None,
    where: Mapping[str, str] | None = None,
) -> DataFrame:
    """Checks of one layer. If a table is absent, only existence is reported."""
    channels = channels if isinstance(channels, DataFrame) else list(channels)
    expected_rows, where = expected_rows or {}, where or {}
    existence = [
        (
            n,
            NAMES["exists"].format(layer=layer, table=name),
            df is not None,
            MESSAGES["exists"].format(where=where.get(name, name)),
        )
        for n, (name, df) in enumerate(tables.items())
    ]
    results = spark.createDataFrame(existence, RESULT_DDL)
    if any(df is None for df in tables.values()):
        return results
    first_no = len(existence)
    for name, df in tables.items():
        checks = table_checks(df, name, channels, expected_rows.get(name))
        results = results.unionByName(evaluate(df, checks, first_no))
        first_no += len(checks)
    return results


def gold_checks(spark, tables, channels, expected_rows=None, where=None) -> DataFrame:
    return layer_checks(spark, "Gold", tables, channels, expected_rows, where)


def mart_checks(spark, tables, channels, expected_rows=None, where=None) -> DataFrame:
    return layer_checks(spark, "Mart", tables, channels, expected_rows, where)


def quarantine_checks(spark: SparkSession, silver_base: str) -> DataFrame:
    """One check per endpoint that was read: nothing had to be put aside."""
    counts = quarantine_counts(spark, silver_base)
    numbered = [(n, e, NAMES["quarantine"].format(table=e)) for n, e in enumerate(ENDPOINTS)]
    names = spark.createDataFrame(numbered, "check_no INT, endpoint STRING, check_name STRING")
    return names.join(counts, "endpoint").select(
        "check_no",
        "check_name",
        (F.col("malformed_rows") == 0).alias("passed"),
        _message("quarantine", F.col("malformed_rows"), F.col("files")).alias("message"),
    )


def expected_row_counts(config: DataFrame, stats: DataFrame) -> dict[str, int]:
    """Row counts that follow from the configured media and the days on which media have statistics.

    ``stats`` are silver statistics: a media may begin later than others.
    """
    days = stats.select("media_hashed_id", F.col("ingest_date").alias("snapshot_date")).distinct()
    days = days.join(config.select("media_hashed_id", "channel"), "media_hashed_id", "left")
    counts = days.agg(
        F.count(F.lit(1)).alias("of_media"),
        F.count_distinct(F.struct("channel", "snapshot_date")).alias("of_channels"),
    ).head()
    return {
        "dim_media": config.count(),
        "fact_media_daily_stats": counts["of_media"],
        "mart_channel_performance": counts["of_channels"],
    }


def run_validation(
    spark: SparkSession,
    gold_base: str,
    mart_base: str,
    channels: DataFrame | Iterable[str],
    expected_rows: Mapping[str, int] | None = None,
    silver_base: str | None = None,
) -> tuple[bool, list]:
    """Run and log every check; returns whether all passed, and the result rows.

    With ``silver_base``, the quarantine is checked, too.
    """
    channels = channels if isinstance(channels, DataFrame) else list(channels)
    layers = [] if silver_base is None else [quarantine_checks(spark, silver_base)]
    for run, base, names in (
        (gold_checks, gold_base, GOLD_TABLES),
        (mart_checks, mart_base, MART_TABLES),
    ):
        tables = {name: find_table(spark, base, name) for name in names}
        where = {name: table_path(base, name) for name in names}
        layers.append(run(spark, tables, channels, expected_rows, where))
    # One row per check, a fixed and small number whatever the size of the tables.
    results = [r for layer in layers for r in layer.orderBy("check_no").collect()]
    passed = sum(r["passed"] for r in results)
    log.info("checks: %d, passed: %d, failed: %d", len(results), passed, len(results) - passed)
    for r in results:
        log.info("[%s] %s -- %s", "PASS" if r["passed"] else "FAIL", r["check_name"], r["message"])
    return passed == len(results), results
