import pytest

from engagement_lake.plans import quality
from engagement_lake.sources.schemas import GOLD_TABLES, MART_TABLES

CHANNELS = ["YouTube", "Facebook"]


def check(df, build, *args):
    (row,) = quality.evaluate(df, [build(df, "t", *args)]).collect()
    return row["passed"], row["message"]


@pytest.fixture(scope="module")
def values(spark):
    return lambda kind, *vs: spark.createDataFrame([(v,) for v in vs], f"c {kind}")


def test_non_empty_and_row_count(values):
    assert check(values("INT", 1, 2), quality.non_empty) == (True, "rows: 2")
    assert check(values("INT"), quality.non_empty)[0] is False
    assert check(values("INT", 1, 2), quality.row_count, 2)[0] is True
    assert check(values("INT", 1), quality.row_count, 2) == (False, "rows: 1; wanted: 2")


def test_columns(values):
    df = values("INT", 1)
    assert check(df, quality.column_exists, "c")[0] is True
    assert check(df, quality.column_exists, "d")[0] is False
    assert check(df, quality.required_columns, ["c"]) == (True, "none missing")
    assert check(df, quality.required_columns, ["c", "d"]) == (False, "missing: ['d']")


@pytest.mark.parametrize("build, args", [
    (quality.no_nulls, ()), (quality.unique, ()), (quality.allowed_values, (["a"],)),
    (quality.numeric_range, (0.0, 1.0)),
])
def test_a_missing_column_fails(values, build, args):
    assert check(values("INT", 1), build, "d", *args) == (False, "no column d to check")


def test_no_nulls(values):
    assert check(values("STRING", "a"), quality.no_nulls, "c")[0] is True
    assert check(values("STRING", "a", None, None), quality.no_nulls, "c") == (False, "rows without a value: 2")


@pytest.mark.parametrize("vs, duplicates", [
    (("a", "b"), 0), (("a", "a", "a"), 2), (("a", None), 0), (("a", None, None), 1), ((), 0),
])
def test_unique_counts_repeated_null(values, vs, duplicates):
    passed, message = check(values("STRING", *vs), quality.unique, "c")
    assert (passed, message) == (duplicates == 0, f"rows beyond the first of their value: {duplicates}")


def test_allowed_values(values):
    assert check(values("STRING", "YouTube"), quality.allowed_values, "c", CHANNELS)[0] is True
    assert check(values("STRING", "YouTube", None), quality.allowed_values, "c", CHANNELS)[0] is False
    passed, message = check(values("STRING", "X", "A", "X", "YouTube"), quality.allowed_values, "c", CHANNELS)
    assert not passed
    assert message == "rows without a value: 0; rows with another value: 3; other values: 2"


def test_many_unexpected_values_still_count_exactly(spark):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS c")
    passed, message = check(df, quality.allowed_values, "c", ["7"])
    assert not passed and message.endswith("rows with another value: 4999; other values: 4999")


def test_all_unexpected_values_are_listed(spark):
    df = spark.range(5000).selectExpr("nullif(CAST(id % 2500 AS STRING), '3') AS c")
    allowed = spark.createDataFrame([("7",), ("7",), (None,)], "v STRING")
    found = {r["value"]: r["rows"] for r in quality.unexpected_values(df, "c", allowed).collect()}
    assert found == {None if n == 3 else str(n): 2 for n in range(2500) if n != 7}
    assert check(df, quality.allowed_values, "c", allowed)[0] is False
    assert check(df.limit(0), quality.allowed_values, "c", allowed)[0] is True


def test_range(values):
    assert check(values("DOUBLE", 0.0, 1.0, None), quality.numeric_range, "c", 0.0, 1.0)[0] is True
    assert check(values("DOUBLE", 1.01), quality.numeric_range, "c", 0.0, 1.0)[0] is False
    assert check(values("DOUBLE", -0.01), quality.numeric_range, "c", 0.0, 1.0)[0] is False
    assert check(values("DOUBLE", None), quality.numeric_range, "c", 0.0, 1.0) == (
        False, "no row holds a number",
    )
    assert check(values("STRING", "0.5", "text"), quality.numeric_range, "c", 0.0, 1.0)[0] is True
    assert check(values("STRING", "text"), quality.numeric_range, "c", 0.0, 1.0)[0] is False
    assert check(values("DOUBLE", float("nan"), 0.5), quality.numeric_range, "c", 0.0, 1.0)[0] is True


def test_catalogue_size(spark, silver):
    def empty(names):
        return {n: silver(n, [{}]) for n in names}

    counts = {"dim_media": 2, "fact_media_daily_stats": 2, "mart_channel_performance": 2}
    gold = quality.gold_checks(spark, empty(GOLD_TABLES), CHANNELS, counts)
    mart = quality.mart_checks(spark, empty(MART_TABLES), CHANNELS, counts)
    names = [r["check_name"] for df in (gold, mart) for r in df.orderBy("check_no").collect()]
    assert (gold.count(), mart.count()) == (31, 25)
    assert len(set(names)) == 56


def test_an_absent_table_stops_its_layer(spark, silver):
    tables = {n: silver(n, [{}]) for n in GOLD_TABLES} | {"dim_media": None}
    results = quality.gold_checks(spark, tables, CHANNELS).orderBy("check_no").collect()
    assert [r["passed"] for r in results] == [False, True, True, True]


@pytest.mark.parametrize("table", [*GOLD_TABLES, *MART_TABLES])
def test_all_checks_of_a_table_share_one_scan(spark, tmp_path, silver, table):
    silver(table, [{}]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = quality.evaluate(df, quality.table_checks(df, table, CHANNELS, 2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Expand" not in plan


def test_checks_by_value_combine_before_the_shuffle(spark, tmp_path):
    df = spark.range(0, 10_000, numPartitions=4).selectExpr("'YouTube' AS channel", "nullif(id, 7) AS k")
    checks = [
        quality.allowed_values(df, "t", "channel", CHANNELS), quality.unique(df, "t", "k"),
        quality.no_nulls(df, "t", "k"), quality.row_count(df, "t", 10_000),
    ]
    assert [r["passed"] for r in quality.evaluate(df, checks).orderBy("check_no").collect()] == [
        True, True, False, True,
    ]
