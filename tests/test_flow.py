from __future__ import annotations

import dataclasses

import pytest

from checks.queries import P5
from checks.workbench import Workbench
from starsmelt.operators.quality import dim_key_unique
from starsmelt.plans.datasets import DATASETS, run
from starsmelt.plans.gold import GOLD_TABLES
from starsmelt.plans.medallion import MedallionTables, Target, quality_report, run_medallion
from starsmelt.plans.silver import BRIDGES, DIMENSIONS, SILVER_TABLES
from starsmelt.sources import NoRecords, PagesMissing, TableMissing, write_parquet

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bench(spark):
    return Workbench(spark, FOLDER)


@pytest.fixture(scope="module")
def flow(spark, bench):
    return run_medallion(spark, bench.pages, bench.new_target())


def content(tables: MedallionTables):
    return {
        name: sorted((tuple(row[c] for c in sorted(df.columns)) for row in df.collect()), key=repr)
        for name, df in tables.items()
    }


def test_all_tables_exist(flow):
    assert len(flow) == len(SILVER_TABLES) + len(GOLD_TABLES) == 20
    assert set(content(flow)) == set(flow)


def test_second_run_is_equal(spark, bench, flow):
    again = run_medallion(spark, bench.pages, flow.target)
    assert content(again) == content(flow)


@pytest.mark.parametrize("buckets", [0, 3])
def test_layout_and_row_order_do_not_matter(spark, bench, flow, buckets):
    path = bench.stage.path(f"shuffled{buckets}")
    write_parquet(bench.bronze.repartition(5, "added"), path)
    other = run_medallion(
        spark, path, bench.new_target(buckets=buckets), source_format="parquet")
    assert content(other) == content(flow)


def test_bridge_ids_are_dimension_ids(flow):
    for (_, columns), bridge in zip(DIMENSIONS.values(), list(BRIDGES)[:5]):
        key = next(iter(columns))
        dim = next(n for n, (_, c) in DIMENSIONS.items() if key in c)
        assert flow[f"silver.{bridge}"].join(flow[f"silver.{dim}"], key, "left_anti").isEmpty()
        assert dim_key_unique(flow[f"silver.{dim}"], key).isEmpty()


def test_fact_has_each_key_once(bench, flow):
    assert flow["gold.fact_items"].count() == bench.bronze.select("id").distinct().count()


def test_datasets_agree_with_tables_written_one_by_one(bench, flow):
    for name in ("kpi", "category_by_family", "top_items"):
        assert run(name, flow).collect() == run(name, bench).collect()


def test_a_failing_step_stops_the_rest(spark, bench):
    target = bench.new_target()
    with pytest.raises(PagesMissing):
        run_medallion(spark, bench.pages, target, expected_pages=10**6)
    empty = bench.stage.path("empty")
    spark.createDataFrame([('{"results":[]}',)], "value string").write.text(empty)
    with pytest.raises(NoRecords):
        run_medallion(spark, empty, target)
    assert not spark.catalog.tableExists(f"{target.silver}.fact_items")


def test_another_application_reads_and_replaces_the_folders(spark, bench, flow):
    """A catalog that does not know the tables: dropping them keeps the folders."""
    target = bench.new_target()
    run_medallion(spark, bench.pages, target)
    for schema in (target.bronze, target.silver, target.gold):
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = MedallionTables(spark, target)
        assert content(other) == content(flow)
        for name, dataset in DATASETS.items():
            if dataset.accepts and name != "top_tags":  # the layout came with the folder
                plan = run(name, other, P5)._jdf.queryExecution().executedPlan().toString()
                assert "hashpartitioning(item_id" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    report = quality_report(MedallionTables(spark, target))
    assert sorted(report.collect()) == sorted(quality_report(flow).collect())
    assert content(run_medallion(spark, bench.pages, target)) == content(flow)


def test_a_bad_extract_leaves_the_tables_as_they_were(spark, bench):
    target = bench.new_target()
    before = content(run_medallion(spark, bench.pages, target))
    rows = MedallionTables(spark, target)["bronze.items"].count()
    empty, broken = bench.stage.path("empty"), bench.stage.path("broken")
    spark.createDataFrame([('{"results":[]}',)], "value string").write.text(empty)
    spark.createDataFrame([('{"results":[',)], "value string").write.text(broken)
    for source, pages in ((empty, None), (broken, None), (bench.pages, 10**6)):
        with pytest.raises(Exception):
            run_medallion(spark, source, target, expected_pages=pages)
        assert MedallionTables(spark, target)["bronze.items"].count() == rows
    assert content(MedallionTables(spark, target)) == before


def test_targets_with_the_same_schemas_do_not_mix(spark, bench, flow, tmp_path):
    first = dataclasses.replace(bench.new_target(), location=str(tmp_path / "a"))
    second = dataclasses.replace(first, location=str(tmp_path / "b"))
    run_medallion(spark, bench.pages, first)
    with pytest.raises(TableMissing, match="fact_items"):
        MedallionTables(spark, second)["gold.fact_items"]
    few = bench.stage.path("few")
    write_parquet(bench.bronze.filter("id < 100"), few)
    run_medallion(spark, few, second, source_format="parquet")
    assert content(MedallionTables(spark, first)) == content(flow)
    assert MedallionTables(spark, second)["gold.fact_items"].count() == 100


def test_bucket_count_follows_the_data():
    target = Target()
    assert [target.buckets_for(rows, 8) for rows in (1, 15_000, 150_000, 10**7, 10**9)] == [
        1, 1, 8, 8, 500]
    assert Target(buckets=0).buckets_for(10**9, 8) == 0
