"""What the physical plans must and must not contain, as they would be on large tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import P5, lineitem_dedupe
from checks.workbench import Workbench
from starsmelt.fixtures import _line_records
from starsmelt.operators.filters import Params, apply_filters
from starsmelt.operators.joins import denormalise
from starsmelt.operators.quality import duplicate_keys, mark_repeats, null_tokens_to_null
from starsmelt.plans.datasets import DATASETS, run

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bench(spark):
    bench = Workbench(spark, FOLDER)
    bench.buckets = 4
    for name in bench:
        bench[name]
    return bench


@pytest.fixture
def large(spark):
    """Plan as if no table were small enough to broadcast, without runtime changes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.maxMetadataStringLength": "100000",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition)", text)


def test_unset_filters_leave_no_trace(bench, large):
    text = plan(apply_filters(bench["gold.fact_items"], bench, Params(category="")))
    assert "Join" not in text and "Filter (" not in text and "PushedFilters: []" in text


def test_set_filters_are_semi_joins_without_a_shuffle(bench, large):
    text = plan(apply_filters(bench["gold.fact_items"], bench, P5))
    assert text.count("LeftSemi") == 2
    assert exchanges(text) == []


def test_dates_and_names_reach_the_scan(bench, large):
    text = plan(apply_filters(bench["gold.fact_items"], bench, P5))
    assert "GreaterThanOrEqual(released,1996-01-01)" in text
    assert "LessThanOrEqual(released,1999-12-31)" in text
    assert "EqualTo(category_name,Brand#4)" in text
    assert "try_cast" not in text.lower()


@pytest.mark.parametrize("name", [name for name, dataset in DATASETS.items() if dataset.accepts])
def test_no_dataset_shuffles_rows_by_item(bench, large, name):
    """Bucketed tables join and count in place; what moves is grouped already."""
    for params in (Params(), P5):
        moved = [e for e in exchanges(plan(run(name, bench, params))) if "item_id" in e or "tag_id" in e]
        assert moved == []


@pytest.mark.parametrize("name", ["category_stats", "top_tags", "top_items"])
def test_top_lists_are_not_sorted_whole(bench, large, name):
    text = plan(run(name, bench))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_top_items_bounds_rows_in_every_task_in_one_scan(bench, large):
    text = plan(run("top_items", bench, P5))
    ranked = text[text.index("WindowGroupLimit"):]
    assert text.count("WindowGroupLimit") == 2
    assert ranked[ranked.index("Exchange"):].count("WindowGroupLimit") == 1
    assert text.count("FileScan") == 3


def test_kpi_has_no_window(bench, large):
    text = plan(run("kpi", bench))
    assert "Window" not in text and "partial_percentile_disc" in text


def test_duplicates_shrink_before_the_shuffle(spark, large):
    text = plan(lineitem_dedupe(spark, FOLDER))
    below = text[text.index("Exchange"):]
    assert text.count("WindowGroupLimit") == 2 and below.count("WindowGroupLimit") == 1


def test_repeated_keys_are_found_from_the_key_column(bench, large):
    text = plan(duplicate_keys(null_tokens_to_null(bench.bronze), ["id"]))
    assert "ReadSchema: struct<id:bigint>" in text
    assert text.count("HashAggregate") == 2


def test_repeated_records_are_marked_in_one_scan(spark, bench, large):
    """At any share of duplicates: half of the keys here, and nothing but the bitmap may be broadcast."""
    repeated = bench.stage.put(bench.bronze.filter("id % 2 = 0").select("id").distinct(), "repeated")
    text = plan(mark_repeats(bench.bronze, ["id"], repeated))
    assert len(re.findall(r"FileScan .*genres", text)) == 1
    wide = text[:text.index("BroadcastExchange")]
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text
    assert exchanges(wide) == [] and len(exchanges(text)) == 1  # the one that makes the bitmap


def test_category_groups_read_the_bridge_once(bench, large):
    text = plan(run("category_by_family", bench, P5))
    assert text.count("FileScan") == 4 and len(re.findall(r"FileScan .*category_name", text)) == 2


def test_bridge_reads_one_member_and_does_not_shuffle(bench, large):
    text = plan(bench.build_silver("bridge_item_platforms"))
    assert exchanges(text) == []
    assert "ReadSchema: struct<id:bigint,_platforms:array<struct<platform:struct<id:bigint>>>>" in text


def test_dimension_collapses_before_the_shuffle(bench, large):
    text = plan(bench.build_silver("dim_stores"))
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_gold_tags_count_before_the_join(bench, large):
    text = plan(bench.build_gold("agg_top_tags"))
    assert text.index("SortMergeJoin") < text.index("partial_count(item_id")


def test_no_python_in_any_plan(bench, large):
    for name in DATASETS:
        assert "Python" not in plan(run(name, bench, P5))


@pytest.mark.parametrize("null_key", [False, True])
def test_hot_key_of_a_dimension_join_is_split(spark, tmp_path, null_key):
    """A third of the rows share one key (or have none): adaptive execution splits that partition."""
    hot = "CAST(NULL AS BIGINT)" if null_key else "7L"
    rows = spark.range(300_000).selectExpr("id", f"IF(id % 3 = 0, {hot}, id % 5000) AS k")
    rows.repartition(16).write.parquet(str(tmp_path / "rows"))
    spark.range(5000).selectExpr("id AS k", "repeat('x', 20) AS name").write.parquet(str(tmp_path / "dim"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = denormalise(
            spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "dim")), "k")
        found = joined.agg(F.count(F.lit(1)), F.count("name"))
        joined_rows = joined.collect()
        assert len(joined_rows) == 300_000
        assert "skew=true" in plan(joined)
        assert found.first()[1] == (200_000 if null_key else 300_000)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lines_move_to_their_order_once_and_are_grouped_there(spark, large):
    text = plan(_line_records(spark, FOLDER))
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    below = text[text.index("Exchange hashpartitioning(l_orderkey"):]
    assert "Aggregate" in text and "Aggregate" not in below


def test_tags_of_an_item_are_grouped_after_they_moved(bench, large):
    text = plan(bench.build_gold("index_item_tags"))
    assert text.count("Exchange hashpartitioning(item_id") == 1
    assert "Aggregate" not in text[text.index("Exchange hashpartitioning(item_id"):]


def test_a_task_holds_the_lists_of_a_bounded_bucket(bench):
    assert [bench.target.buckets_for(rows, 12) for rows in (9_000_000, 54_000_000)] == [45, 270]


def test_lines_move_what_an_order_counts_as_one_number(spark, large):
    """The flags of a line are bits of a number before its first move, so no move carries their text."""
    text = plan(_line_records(spark, FOLDER))
    first_move = text[:text.index("Exchange hashpartitioning(l_partkey")]
    assert "marks" in first_move and "l_returnflag" not in first_move and "l_discount" not in first_move


def test_records_that_are_read_once_are_not_staged(spark):
    bench = Workbench(spark, FOLDER)
    assert bench.bronze.count() == 1515 and bench.pages
    assert "records" not in vars(bench)
    assert "FileScan parquet" in plan(bench.records) and "lineitem" not in plan(bench.records_once)
