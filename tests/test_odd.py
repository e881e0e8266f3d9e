"""The odd records really hold what they are for."""

from __future__ import annotations

from checks.workbench import workbench
from starsmelt.operators.quality import date_rejects, dim_key_unique

FOLDER = "/root/testdata/sf0.001"


def test_odd_records_hold_every_case(spark):
    bench = workbench(spark, FOLDER, odd=True)
    assert date_rejects(bench.bronze, "released").first()[0] > 20
    assert dim_key_unique(bench["silver.dim_categories"], "category_id").count() > 20
    assert dim_key_unique(bench["silver.dim_content_ratings"], "content_rating_id").count() == 4
    bridge = bench["silver.bridge_item_categories"]
    assert bridge.filter("category_id IS NULL").isEmpty()
    assert bridge.count() > bridge.distinct().count()
    assert bench["gold.fact_items"].count() > bench["silver.fact_items"].count()
    plain = workbench(spark, FOLDER)["silver.bridge_item_categories"].distinct()
    assert bridge.distinct().count() < plain.count()
