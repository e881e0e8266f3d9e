"""All datasets of one selection evaluated together: the rows of each alone, from one pass."""

from __future__ import annotations

import re

import pytest
from compare import _rows
from test_matrix import SETS
from test_plans import bench, exchanges, large, plan  # noqa: F401

from checks.workbench import workbench
from starsmelt.operators.filters import Params
from starsmelt.plans.datasets import DATASETS, apply_to_all, narrowed
from starsmelt.plans.selection import apply_together, grouped_entries
from starsmelt.sources import Stage

FOLDER = "/root/testdata/sf0.001"
MORE = {
    "absent name": Params(category="no such name"),
    "no date": Params(family="ASIA", date_from="not a date"),
    "no items": Params(date_from="2400-01-01"),
}


def assert_same(tables, params, stage):
    together, alone = apply_together(tables, params, stage), apply_to_all(tables, params)
    assert list(together) == list(alone)
    for name, df in alone.items():
        assert together[name].schema.simpleString() == df.schema.simpleString(), name
        assert _rows(df.columns, together[name].collect()) == _rows(df.columns, df.collect()), name


@pytest.mark.parametrize("label", ["P0", "P1", "P3", "P5", *MORE])
def test_rows_are_those_of_each_dataset_alone(spark, label):
    with Stage(spark) as stage:
        assert_same(workbench(spark, FOLDER), {**SETS, **MORE}[label], stage)


@pytest.mark.parametrize("label", ["P2", "P4"])
def test_names_that_repeat_and_ids_with_two_names(spark, label):
    """Items with several fact rows, repeated bridge rows and NULL ids and names."""
    with Stage(spark) as stage:
        assert_same(workbench(spark, FOLDER, odd=True), SETS[label], stage)


def test_empty_tables(spark):
    bench = workbench(spark, FOLDER)
    names = ("fact_items", "bridge_categories", "bridge_platform_families", "bridge_stores",
             "bridge_votes", "index_item_tags", "index_largest_categories")
    empty = {f"gold.{name}": bench[f"gold.{name}"].limit(0) for name in names}
    with Stage(spark) as stage:
        assert_same(empty, SETS["P4"], stage)


def test_only_lists_that_a_chart_needs_are_joined(bench, large):  # noqa: F811
    text = plan(grouped_entries(bench, Params(date_from="2000-01-01"), ["kpi", "release_trend"]))
    assert text.count("FileScan") == 1 and "Join" not in text


@pytest.mark.parametrize("label", ["P4", "P5"])
def test_one_scan_of_the_fact_and_of_each_bridge(bench, large, label):  # noqa: F811
    """Nothing moves by item, and no table is read twice, for the ten charts of groups."""
    charts = [name for name in narrowed(SETS[label]) if name != "top_items"]
    assert len(charts) == 10 == len([d for d in DATASETS.values() if d.accepts]) - 1
    text = plan(grouped_entries(bench, SETS[label], charts))
    assert len(re.findall(r"FileScan .*released", text)) == 1
    assert text.count("FileScan") == 7  # the fact, four bridges, the tags, the five largest names
    assert [e for e in exchanges(text) if "item_id" in e] == []
    assert len(exchanges(text)) == 1  # of groups, which were added up before


@pytest.mark.parametrize("adaptive", ["false", "true"])
def test_lists_of_items_are_never_broadcast(spark, bench, large, adaptive):  # noqa: F811
    """However small the bridges' files: what the driver would collect is the lists of all items."""
    charts = [name for name in narrowed(SETS["P4"]) if name != "top_items"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    groups = grouped_entries(bench, SETS["P4"], charts)
    groups.collect()  # adaptive execution has then chosen its joins
    text = plan(groups).split("+- == Initial Plan ==")[0]
    assert text.count("SortMergeJoin") == 5
    assert text.count("BroadcastExchange") == text.count("BroadcastHashJoin") == 1  # the five largest names
    assert [e for e in exchanges(text) if "item_id" in e] == []


def test_alone_they_read_the_fact_eleven_times(bench, large):  # noqa: F811
    found = apply_to_all(bench, SETS["P4"]).values()
    assert sum(len(re.findall(r"FileScan .*released", plan(df))) for df in found) == 11


def test_no_entry_of_an_item_is_kept_to_count_it(bench, large):  # noqa: F811
    """A distinct count would keep a key for each item and group of every chart in a task."""
    charts = [name for name in narrowed(SETS["P4"]) if name != "top_items"]
    text = plan(grouped_entries(bench, SETS["P4"], charts))
    assert not re.search(r"keys?=\[chart[^\]]*item_id", text)


def test_rows_of_an_item_with_two_ratings_count_once(spark):
    """By hand: two fact rows of an item, a name that repeats in its bridge, and an item without an id."""
    fact = spark.createDataFrame(
        [(1, "a", 2000, 1.0, 3, 20), (1, "b", 2000, 1.0, 3, 20), (2, "a", 2001, 2.0, 0, 20), (None, "a", 2001, 3.0, 5, 20)],
        "item_id bigint, content_rating string, release_year int, rating double, usage_hrs bigint, ratings_count bigint"
    ).selectExpr("*", "make_date(release_year, 1, 1) AS released", "string(item_id) AS item_name")
    names = {"bridge_categories": "category_name", "bridge_platform_families": "platform_family_name",
             "bridge_stores": "store_name"}
    tables = {"gold.fact_items": fact, **{
        f"gold.{table}": spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (2, None)], f"item_id bigint, {name} string")
        for table, name in names.items()}}
    tables["gold.bridge_votes"] = spark.createDataFrame([(1, "A", 2)], "item_id bigint, vote_title string, vote_count bigint")
    tables["gold.index_item_tags"] = spark.sql("SELECT 1L AS item_id, array(named_struct('tag_name', 't')) AS tags")
    for params in (Params(date_from="1999-01-01"), Params(date_from="1999-01-01", content_rating="b"),
                   Params(date_from="1999-01-01", content_rating="a", category="y")):
        with Stage(spark) as stage:
            assert_same(tables, params, stage)
