from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starsmelt.operators.membership import key_bitmap, mark_members
from starsmelt.operators.quality import (
    date_rejects,
    dedupe,
    dedupe_by_key,
    dedupe_report,
    dim_key_unique,
    null_tokens_to_null,
)
from starsmelt.schemas import NULL_TOKENS
from starsmelt.sources import Stage


def values(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("token", NULL_TOKENS)
def test_tokens_in_every_spelling(spark, token):
    texts = [token, token.upper(), token.title(), f"  {token} ", " " * 40 + token]
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    assert null_tokens_to_null(df).filter("x IS NOT NULL").isEmpty()


@pytest.mark.parametrize("text", ["0", "nano", " a ", "\tNaN", "null null", "n a", "ｎａ", "İ", "x" * 999])
def test_other_text_is_unchanged(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    assert null_tokens_to_null(df).first()["x"] == text


def test_only_top_level_strings_are_cleaned(spark):
    df = spark.sql("SELECT 'na' AS a, array('na') AS b, named_struct('c', 'na') AS s, 1 AS n, 'na' AS k")
    row = null_tokens_to_null(df, columns=["a"]).first()
    assert (row["a"], row["k"]) == (None, "na")
    row = null_tokens_to_null(df).first()
    assert (row["a"], row["b"], row["s"]["c"], row["n"], row["k"]) == (None, ["na"], "na", 1, None)


def test_own_tokens(spark):
    df = spark.createDataFrame([("Unknown",), ("na",)], "x string")
    assert values(null_tokens_to_null(df, tokens=("unknown",))) == [("na",), (None,)]


ROWS = [
    (1, "b", None), (1, "a", 5), (1, "a", None), (2, None, 1), (2, "z", 0),
    (None, "y", 1), (None, "x", 2), (3, "only", 3),
]
FIRST = [(1, "a", 5), (2, "z", 0), (3, "only", 3), (None, "x", 2)]


def test_first_by_content_nulls_last_and_null_is_one_key(spark):
    df = spark.createDataFrame(ROWS, "id bigint, a string, b bigint")
    assert values(dedupe_by_key(df, ["id"])) == sorted(FIRST, key=repr)


def test_order_columns_can_be_chosen(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "b", 2)], "id bigint, a string, b bigint")
    assert values(dedupe_by_key(df, ["id"], ["b"])) == [(1, "b", 2)]


def test_survivor_does_not_depend_on_partitioning(spark):
    rows = [(i % 40, f"t{i % 7}", i) for i in range(400)]
    results = []
    for seed, parts in ((0, 1), (1, 5), (2, 13)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id bigint, a string, b bigint").repartition(parts)
        results.append(values(dedupe_by_key(df, ["id"])))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 40


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_dedupe_with_broadcast_or_sorted_keys(spark, threshold):
    df = spark.createDataFrame(ROWS, "id bigint, a string, b bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert values(dedupe(df, ["id"], Stage(spark))) == sorted(FIRST, key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dedupe_on_two_keys(spark):
    rows = [(1, None, 2), (1, None, 1), (1, "a", 1), (None, None, 7), (None, None, 6)]
    df = spark.createDataFrame(rows, "id bigint, a string, b bigint")
    expected = sorted([(1, None, 1), (1, "a", 1), (None, None, 6)], key=repr)
    assert values(dedupe(df, ["id", "a"], Stage(spark))) == expected


def test_dedupe_without_repeats_or_rows(spark):
    df = spark.range(10).withColumn("a", F.lit("x"))
    assert values(dedupe(df, ["id"], Stage(spark))) == sorted(values(df), key=repr)
    assert dedupe(df.limit(0), ["id"], Stage(spark)).count() == 0


def test_hot_key(spark):
    hot = spark.range(30_000).select(F.lit(7).cast("bigint").alias("id"), F.col("id").alias("b"))
    rest = spark.range(60_000).select((F.col("id") + 100).alias("id"), F.col("id").alias("b"))
    df = hot.unionByName(rest)
    for result in (dedupe_by_key(df, ["id"]), dedupe(df, ["id"], Stage(spark))):
        assert result.count() == 60_001
        assert result.filter("id = 7").first()["b"] == 0


def test_report_counts_null_as_a_key(spark):
    df = spark.createDataFrame(ROWS, "id bigint, a string, b bigint")
    assert tuple(dedupe_report(df, ["id"]).first()) == (8, 4, 4)
    assert tuple(dedupe_report(df.limit(0), ["id"]).first()) == (0, 0, 0)


def test_date_rejects(spark):
    df = spark.createDataFrame([("2020-01-02",), ("",), ("2020-13-45",), (None,)], "d string")
    assert date_rejects(df, "d").first()["date_rejects"] == 2
    assert date_rejects(null_tokens_to_null(df), "d").first()["date_rejects"] == 1


def test_dim_key_unique_names_the_offenders(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id bigint, name string")
    assert values(dim_key_unique(dim, "id")) == [(1, 2)]


def test_marked_keys_are_never_missed(spark):
    """Every member is marked, whatever its bit; of the others no more than share one."""
    df = spark.range(60_000).selectExpr("IF(id % 7 = 0, NULL, id) AS k", "id % 5 AS j", "id", "'x' AS bucket", "1 AS words")
    for rule in ("id % 3 = 0", "id < 70000", "id = 0", "id < 0"):
        members = df.filter(rule).select("k", "j")
        marked = mark_members(df, ["k", "j"], key_bitmap(members, ["k", "j"]), "again")
        assert marked.columns == [*df.columns, "again"]
        sure = members.distinct().withColumn("is", F.lit(True))
        both = marked.join(sure, marked["k"].eqNullSafe(sure["k"]) & (marked["j"] == sure["j"]), "left")
        assert both.filter("is AND NOT again").isEmpty() and both.count() == 60_000
        assert both.filter("again AND is IS NULL").count() < 200


@pytest.mark.parametrize("share", [2, 20, 1000])
def test_dedupe_is_exact_at_any_share_of_repeats(spark, share):
    rows = spark.range(6000).selectExpr(f"IF(id % {share} = 0, id % 90, id) AS k", "id % 11 AS v", "id")
    with Stage(spark) as stage:
        found = sorted(map(tuple, dedupe(rows, ["k"], stage).collect()))
    assert found == sorted(map(tuple, dedupe_by_key(rows, ["k"]).collect()))


def test_dedupe_stages_unique_rows_without_sorting_them(spark, tmp_path):
    """The wide rows go to disk as they come, are derived once each, and repeats are ranked."""
    rows = [(1, "b"), (1, "a"), (2, "c"), (None, "e"), (None, "d")]
    df = spark.createDataFrame(rows, "id bigint, a string")
    written = []
    with Stage(spark, str(tmp_path / "stage")) as stage:
        found = dedupe(df, ["id"], stage, derive=lambda kept: written.append(kept) or kept.withColumn(
            "b", F.upper("a")))
        assert values(found) == sorted([(1, "a", "A"), (2, "c", "C"), (None, "d", "D")], key=repr)
        assert [c for c in found.columns] == ["id", "a", "b"]
        assert not list((tmp_path / "stage").glob("unique-*/_copies=*"))  # a partitioned write sorts all rows
    assert len(written) == 2
