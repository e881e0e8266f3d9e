"""Whole queries on tables where one order, part, supplier and item id hold a third of the rows."""

from __future__ import annotations

import duckdb
import pytest
from compare import STAR, assert_equal, connect

import __spark_entry__ as entry

SOURCE = "/root/testdata/sf0.001"
SKEWED = {
    "lineitem": """l_linenumber % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_quantity % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey""",
    "orders": "o_custkey % 3 = 0 THEN 11 ELSE o_orderkey END AS o_orderkey",
}
NAMES = [
    "dedupe_by_key", "dedupe_report", "page_flatten", "silver_fact_items", "silver_bridge_item_tags",
    "silver_bridge_item_votes", "silver_write_all", "gold_fact_items", "gold_bridge_stores",
    "gold_agg_top_tags", "gold_write_all", "filter_family", "kpi", "category_stats", "content_rating_dist",
    "vote_breakdown", "top_tags", "store_dist", "top_items", "category_by_family",
    "category_by_family_filtered", "medallion_end_to_end",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    with duckdb.connect() as duck:
        for name in STAR:
            change = f"* REPLACE (CASE WHEN {SKEWED[name]})" if name in SKEWED else "*"
            duck.execute(f"COPY (SELECT {change} FROM '{SOURCE}/{name}.parquet') "
                         f"TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, folder, name):
    with connect(folder) as duck:
        assert_equal(entry.queries()[name](spark, folder), duck, entry.oracle_sql()[name])
