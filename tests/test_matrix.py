"""Every dataset under every parameter set of FIXTURES.md section 4, against DuckDB."""

from __future__ import annotations

import pytest
from compare import _rows, connect

from checks.oracle import BASE, dataset_sql
from checks.workbench import workbench
from starsmelt.operators.filters import Params, apply_filters
from starsmelt.plans.datasets import DATASETS, run

FOLDER = "/root/testdata/sf0.001"
SETS = {
    "P0": Params(), "P1": Params(category="Brand#4"), "P2": Params(family="ASIA"),
    "P3": Params(content_rating="Not Rated"), "P4": Params(date_from="1996-01-01", date_to="1999-12-31"),
    "P5": Params("Brand#4", "ASIA", "Not Rated", "1996-01-01", "1999-12-31"),
}
ITEMS = {"P0": 1500, "P1": 190, "P2": 500, "P3": 297, "P4": 910, "P5": 7}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("label", list(SETS))
def test_items(spark, label):
    bench = workbench(spark, FOLDER)
    assert apply_filters(bench["gold.fact_items"], bench, SETS[label]).count() == ITEMS[label]


@pytest.mark.parametrize("label", list(SETS))
@pytest.mark.parametrize("name", [name for name, dataset in DATASETS.items() if dataset.accepts])
def test_dataset(spark, duck, name, label):
    found = run(name, workbench(spark, FOLDER), SETS[label])
    result = duck.execute(f"{BASE} {dataset_sql(name, vars(SETS[label]))}")
    names = [column[0] for column in result.description]
    assert _rows(found.columns, found.collect()) == _rows(names, result.fetchall())


def test_sizes_of_the_fixture(spark):
    bench = workbench(spark, FOLDER)
    sizes = {name: bench[f"silver.{name}"].count() for name in (
        "fact_items", "dim_categories", "bridge_item_categories", "bridge_item_platform_families",
        "dim_tags", "bridge_item_tags", "bridge_item_votes")}
    assert bench.bronze.count() == 1515
    assert sizes == {
        "fact_items": 1500, "dim_categories": 25, "bridge_item_categories": 5479,
        "bridge_item_platform_families": 3842, "dim_tags": 200, "bridge_item_tags": 5942,
        "bridge_item_votes": 3287}
