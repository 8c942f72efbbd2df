import pytest
from pyspark.sql import functions as F

from engagement_lake import functions as fn
from engagement_lake.functions.names import snake_case, snake_case_columns


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).head())


def double(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize(
    "numerator, denominator, expected",
    [(1, 4, 0.25), (1, 0, 0.0), (1, None, 0.0), (None, 4, None), (None, 0, 0.0)],
)
def test_safe_divide_is_zero_without_denominator(spark, numerator, denominator, expected):
    n, d = (F.lit(v).cast("bigint") for v in (numerator, denominator))
    assert one(spark, fn.safe_divide(n, d)) == (expected,)


@pytest.mark.parametrize(
    "plays, loads, expected",
    [(1, 4, 0.25), (1, 0, None), (1, None, None), (None, 4, None)],
)
def test_play_rate_is_null_without_loads(spark, plays, loads, expected):
    p, n = (F.lit(v).cast("bigint") for v in (plays, loads))
    assert one(spark, fn.play_rate(p, n)) == (expected,)


@pytest.mark.parametrize(
    "average, segment",
    [
        (-0.1, "0-25%"), (0.0, "0-25%"), (0.25, "0-25%"), (0.26, "26-50%"), (0.5, "26-50%"),
        (0.75, "51-75%"), (0.76, "76-100%"), (1.2, "76-100%"),
        (None, "76-100%"),  # a known oddity: no average at all counts as the top band
    ],
)
def test_engagement_segment_bounds_are_inclusive(spark, average, segment):
    assert one(spark, fn.engagement_segment(double(average))) == (segment,)


def test_malformed_text_becomes_null_in_ansi_mode(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert one(
        spark,
        fn.to_double(F.lit("abc")), fn.to_double(F.lit("0.5")), fn.to_long(F.lit("12")),
        fn.to_long(F.lit("12.0")), fn.to_long(F.lit("x")), fn.to_int(F.lit("99999999999")),
        fn.to_boolean(F.lit("true")), fn.to_boolean(F.lit("maybe")), fn.to_timestamp(F.lit("nope")),
    ) == (None, 0.5, 12, 12, None, None, True, None, None)


def test_to_timestamp_reads_offsets(spark):
    shown = [
        fn.to_timestamp(F.lit(t)).cast("string")
        for t in ("2024-01-31T23:30:00+02:00", "2024-01-31T23:30:00-02:00", "2024-01-31T23:30:00Z")
    ]
    assert one(spark, *shown) == (
        "2024-01-31 21:30:00", "2024-02-01 01:30:00", "2024-01-31 23:30:00",
    )


def test_json_text_is_compact_with_sorted_keys(spark):
    assert one(
        spark,
        fn.json_text(F.lit('{"b": 1, "a": {"d": null, "c": [1, 2]}}')),
        fn.json_text(F.lit("plain words")),
        fn.json_text(F.lit(None).cast("string")),
    ) == ('{"a":{"c":[1,2],"d":null},"b":1}', "plain words", None)


@pytest.mark.parametrize(
    "section, expected",
    [
        ("Intro", (None, "Intro")),
        ('{"id": 7, "name": "Intro"}', (7, "Intro")),
        ('{"id": 7}', (7, None)),
        ('{"name": "Intro"}', (None, "Intro")),
        (None, (None, None)),
    ],
)
def test_section_is_text_or_object(spark, section, expected):
    column = F.lit(section).cast("string")
    assert one(spark, *fn.section_parts(column)) == expected


def test_distinct_text_sorts_and_skips_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c STRING")
    assert df.agg(fn.distinct_text("c")).head()[0] == "a | b"
    assert df.where("c IS NULL").agg(fn.distinct_text("c")).head()[0] == ""


def test_snake_case(spark):
    assert snake_case("  Total -- Views (2024)!") == "total_views_2024"
    assert snake_case_columns(spark.range(1).toDF("Event-ID")).columns == ["event_id"]
