"""Silver, gold and datasets on small hand-made records."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starsmelt.operators.filters import ALL_FILTERS, Params, apply_filters
from starsmelt.plans.datasets import DATASETS, apply_to_all, run, targets
from starsmelt.plans.feeds import FEEDS, feed
from starsmelt.plans.gold import GOLD_TABLES, build_gold
from starsmelt.plans.silver import SILVER_TABLES, build_silver
from starsmelt.schemas import BRONZE_FIELDS, BRONZE_SCHEMA, ENCODED_FIELDS
from starsmelt.sources import Stage


def record(**fields):
    row = {name: None for name in BRONZE_FIELDS}
    row.update(fields)
    return tuple(
        json.dumps(row[name]) if name in ENCODED_FIELDS and row[name] is not None else row[name]
        for name in BRONZE_FIELDS
    )


def pairs(*entities):
    return [{"id": i, "name": n} for i, n in entities]


def wrapped(member, *entities):
    return [{member: entity} for entity in pairs(*entities)]


def tags(*entities):
    return [{"id": i, "name": n, "language": lang} for i, n, lang in entities]


RECORDS = [
    record(id=1, name="Alpha", released="2020-01-02", rating=4.5, ratings_count=50, added=1, playtime=10,
           genres=pairs((1, "Action"), (2, "Puzzle")),
           parent_platforms=wrapped("platform", (1, "PC"), (2, "Console")),
           platforms=wrapped("platform", (11, "PC")), stores=wrapped("store", (5, "Shop")),
           tags=tags((1, "fun", "eng"), (2, "fun", "eng"), (3, "весело", "rus")),
           ratings=[{"id": 5, "title": "good", "count": 7, "percent": 70.0}],
           added_by_status={"yet": 1, "playing": 2}, esrb_rating={"id": 4, "name": "Teen"}),
    record(id=1, name="Alpha", released="2020-01-02", rating=4.5, ratings_count=50, added=2, playtime=99),
    record(id=2, name=" none ", released="2021-13-45", rating=4.5, ratings_count=50, playtime=0,
           genres=pairs((1, "Action"), (3, "n/a")), esrb_rating={"id": 9, "name": "Not Rated"},
           parent_platforms=wrapped("platform", (1, "PC")), tags=tags((1, "fun", "eng")),
           ratings=[{"id": 5, "title": "good", "count": 1}, {"id": 1, "title": "none", "count": 5}]),
    record(id=3, name="Gamma", released="1985-06-30", rating=3.0, ratings_count=9, playtime=4,
           genres=pairs((2, "Puzzle"), (2, "Puzzle")), stores=wrapped("store", (5, "Shop"))),
    record(id=4, name="Delta", released="2021-03-04", rating=None, ratings_count=10, playtime=6,
           genres=[], tags=tags((4, "n/a", "eng"))),
]


@pytest.fixture(scope="module")
def tables(spark):
    stage = Stage(spark)
    bronze = spark.createDataFrame(RECORDS, BRONZE_SCHEMA)
    silver = {n: stage.put(df, f"silver/{n}") for n, df in build_silver(bronze, stage).items()}
    gold = {n: stage.put(df, f"gold/{n}") for n, df in build_gold(silver).items()}
    return {**{f"silver.{n}": df for n, df in silver.items()},
            **{f"gold.{n}": df for n, df in gold.items()}}


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns or df.columns).collect()), key=repr)


def test_all_tables(tables):
    assert [name.split(".")[1] for name in tables] == [*SILVER_TABLES, *GOLD_TABLES]
    assert len(SILVER_TABLES) == 13 and len(GOLD_TABLES) == 7


def test_fact(tables):
    fact = tables["silver.fact_items"]
    columns = ("item_id", "item_name", "released", "usage_hrs", "added_playing", "content_rating_id")
    assert rows(fact, *columns) == [
        (1, "Alpha", dt.date(2020, 1, 2), 10, 2, 4), (2, None, None, 0, None, 9),
        (3, "Gamma", dt.date(1985, 6, 30), 4, None, None), (4, "Delta", dt.date(2021, 3, 4), 6, None, None)]


def test_token_inside_json_lives_until_gold(tables):
    assert (3, "n/a") in rows(tables["silver.dim_categories"])
    assert rows(tables["gold.bridge_categories"].filter("category_id = 3"), "category_name") == [(None,)]
    assert rows(tables["gold.bridge_votes"].filter("vote_id = 1"), "vote_title") == [(None,)]


def test_bridge_is_not_deduplicated(tables):
    assert rows(tables["gold.bridge_categories"].filter("item_id = 3"), "category_name") == [
        ("Puzzle",), ("Puzzle",)]


def test_gold_fact_has_name_and_date_parts(tables):
    fact = tables["gold.fact_items"]
    assert rows(fact, "item_id", "content_rating", "release_year", "release_month") == [
        (1, "Teen", 2020, 1), (2, "Not Rated", None, None), (3, None, 1985, 6), (4, None, 2021, 3)]


def test_dimension_id_with_two_names_multiplies_fact_rows(spark, tables):
    silver = {n: tables[f"silver.{n}"] for n in SILVER_TABLES}
    extra = spark.createDataFrame([(4, "Teen+")], "content_rating_id bigint, content_rating string")
    silver["dim_content_ratings"] = silver["dim_content_ratings"].unionByName(extra)
    fact = build_gold(silver)["fact_items"]
    assert rows(fact.filter("item_id = 1"), "content_rating") == [("Teen",), ("Teen+",)]
    assert fact.count() == 5


def test_top_tags_by_id_and_by_name(tables):
    assert rows(tables["gold.agg_top_tags"]) == [(1, "fun", 2), (2, "fun", 1), (4, None, 1)]
    assert rows(run("top_tags", tables)) == [("fun", 2), ("n/a", 1)]


def test_option_lists(tables):
    assert [r[0] for r in run("opt_categories", tables).collect()] == ["Action", "Puzzle"]
    assert [r[0] for r in run("opt_content_ratings", tables).collect()] == ["Not Rated", "Teen"]


def test_null_and_literal_not_rated_are_two_rows(tables):
    assert rows(run("content_rating_dist", tables)) == [("Not Rated", 1), ("Not Rated", 2), ("Teen", 1)]


def test_kpi(tables):
    assert rows(run("kpi", tables)) == [(3, 3.75, 6.0, 23.0)]
    assert rows(run("kpi", tables, Params(category="nothing"))) == [(0, None, None, None)]


def test_category_stats_counts_items_once_but_averages_rows(tables):
    assert rows(run("category_stats", tables)) == [("Action", 2, 4.5, 5.0), ("Puzzle", 2, 3.5, 6.0)]


def test_release_trend_drops_old_and_unknown_years(tables):
    assert rows(run("release_trend", tables)) == [(2020, 1, 4.5), (2021, 1, None)]
    build = DATASETS["release_trend"].build
    assert rows(build(tables, Params(), as_of_year=2020)) == [(2020, 1, 4.5)]


def test_top_items(tables):
    assert [tuple(r) for r in run("top_items", tables).collect()] == [
        (None, None, 4.5, 50, 0, "Not Rated"), ("Alpha", "2020-01-02", 4.5, 50, 10, "Teen")]


def test_rating_vs_usage_needs_both(tables):
    assert rows(run("rating_vs_usage", tables)) == [("Action", 4.5, 10.0, 1), ("Puzzle", 3.5, 6.0, 2)]


def test_null_name_takes_a_place_among_the_largest(spark, tables):
    def bridge(name, count):
        return [(i, name) for i in range(count)]

    names = ["a", None, "c", "d", "e", "f", "g"]
    data = [row for rank, name in enumerate(names) for row in bridge(name, 20 - rank)]
    items = spark.range(20).selectExpr("id AS item_id", "date'2020-01-01' AS released")
    families = items.select("item_id", F.lit("PC").alias("platform_family_name"))
    star = {
        "gold.fact_items": items,
        "gold.bridge_categories": spark.createDataFrame(data, "item_id bigint, category_name string"),
        "gold.bridge_platform_families": families.unionByName(families),
    }
    assert rows(run("category_by_family", star)) == [
        ("PC", "Other", 15), ("PC", "a", 20), ("PC", "c", 18), ("PC", "d", 17), ("PC", "e", 16)]


@pytest.mark.parametrize("params, expected", [
    (Params(), [1, 2, 3, 4]),
    (Params(category="Puzzle"), [1, 3]),
    (Params(family="PC"), [1, 2]),
    (Params(content_rating="Not Rated"), [2, 3, 4]),
    (Params(date_from="2020-01-02"), [1, 4]),
    (Params(date_to=dt.date(2020, 1, 2)), [1, 3]),
    (Params(date_from="not a date"), [1, 2, 3, 4]),
    (Params(date_from="2020-13-45", date_to=""), [1, 2, 3, 4]),
    (Params(category="Puzzle", family="PC", date_from="2000-01-01"), [1]),
    (Params(category="it's"), []),
])
def test_filters(tables, params, expected):
    found = apply_filters(tables["gold.fact_items"], tables, params)
    assert sorted(row["item_id"] for row in found.select("item_id").collect()) == expected


def test_empty_text_is_no_filter():
    assert Params(category="", family="", content_rating="", date_from="", date_to="") == Params()


EVERYTHING = Params("Puzzle", "PC", "Teen", "2000-01-01", "2030-01-01")


@pytest.mark.parametrize("name", list(DATASETS))
def test_filters_that_are_not_accepted_change_nothing(tables, name):
    ignored = ALL_FILTERS - DATASETS[name].accepts
    assert rows(run(name, tables, EVERYTHING.only(ignored))) == rows(run(name, tables))


def test_targets():
    assert {param: len(targets(param)) for param in ALL_FILTERS} == {
        "category": 8, "family": 8, "content_rating": 8, "date_from": 11, "date_to": 11}


def test_one_selection_over_all_datasets(tables):
    selected = apply_to_all(tables, EVERYTHING)
    assert len(selected) == 11
    assert rows(selected["kpi"]) == [(1, 4.5, 10.0, 50.0)]
    assert list(apply_to_all(tables, Params(category="Puzzle"))) == targets("category")
    assert list(apply_to_all(tables, Params(date_from="2000-01-01"))) == targets("date_from")
    assert not apply_to_all(tables, Params())


@pytest.mark.parametrize("name", list(FEEDS))
def test_feed_is_a_projection(tables, name):
    dataset, columns = FEEDS[name]
    found = feed(name, tables, EVERYTHING)
    assert tuple(found.columns) == columns
    assert rows(found) == rows(run(dataset, tables, EVERYTHING), *columns)
