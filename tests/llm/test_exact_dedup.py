"""Exact duplicates against a plain version, also with hashes that collide."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from engagement_lake.llm.exact_dedup import exact_groups, without_copies

DDL = "doc_id long, text string, `key` string, body int, hash string, variant int"
ROWS = [
    (1, None, "a", 1, "x", 1),
    (2, "", "b", 2, "x", 1),
    (3, " \t\n ", None, None, None, None),
    (4, "\x0b", "c", 1, "x", 1),
    (9, "one two", "c", 1, "x", 1),
    (5, "one \r\n two", "c", 1, "x", 1),
    (5, "one \r\n two", "c", 1, "x", 1),
    (7, "One two", "c", 1, "x", 1),
    (None, "naïve café", "c", 1, "x", 1),
    (8, "naïve  café", "c", 1, "x", 1),
    (None, "alone", "c", 1, "x", 1),
    (None, "alone", "c", 1, "x", 1),
    (10, "no white", "c", 1, "x", 1),
    (11, "no white", "c", 1, "x", 1),
    (12, "long text " * 30_000, "c", 1, "x", 1),
    (13, "long text\n" * 30_000, "c", 1, "x", 1),
    (14, "long text " * 29_999 + "long texts", "c", 1, "x", 1),
]


def plain(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row[0])
    found = []
    for text, ids in groups.items():
        least = min(ids, key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        ids.sort(key=lambda i: i != least)
        found += [(i, least, len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(
        ((r.key, r.keep_key, r.group_size, r.kept, r.sha256.hex()) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize(
    "digest",
    [None, lambda body: F.unhex(F.md5(F.substring(body, 1, 3))), lambda body: F.lit(b"same")],
    ids=["content", "weak", "constant"],
)
def test_groups_are_those_of_equal_texts(spark, digest):
    df = spark.createDataFrame(ROWS, DDL).repartition(5)
    found = exact_groups(df) if digest is None else exact_groups(df, digest=digest)
    expected = plain(ROWS)
    assert rows_of(found) == expected
    assert sum(r[3] for r in expected) == len({r[4] for r in expected})


def test_hot_group_and_others_together(spark):
    rows = [(i, "copy of one" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, t string")
    found = exact_groups(df, "id", "t")
    assert rows_of(found) == plain(rows)


def test_rules_of_the_caller(spark):
    df = spark.createDataFrame([("b", "A x"), ("a", "a X"), ("c", "a  x")], "id string, text string")
    found = exact_groups(df, "id", normal=F.lower)
    assert sorted((r.key, r.keep_key, r.group_size) for r in found.collect()) == [("a", "a", 2), ("b", "a", 2), ("c", "c", 1)]


def test_documents_that_stay_keep_their_columns(spark):
    df = spark.createDataFrame(ROWS, DDL)
    kept = without_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (r[0] for r in plain(ROWS) if r[3]), key=repr
    )
    assert kept.where("doc_id = 5").head().text == "one \r\n two"


def test_empty_table(spark):
    df = spark.createDataFrame([], DDL)
    assert exact_groups(df).collect() == [] and without_copies(df).collect() == []
