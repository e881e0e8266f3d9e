"""Chart feeds: the columns of a dataset that one chart shows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starsmelt.operators.filters import Params
from starsmelt.plans.datasets import Tables, run

# Feed -> (dataset, columns).
FEEDS = {
    "category_options": ("opt_categories", ("category_name",)),
    "family_options": ("opt_families", ("platform_family_name",)),
    "content_rating_options": ("opt_content_ratings", ("content_rating",)),
    "total_items": ("kpi", ("total_items",)),
    "avg_rating": ("kpi", ("avg_rating",)),
    "median_usage": ("kpi", ("median_usage_hrs",)),
    "avg_ratings_count": ("kpi", ("avg_ratings_count",)),
    "categories_by_count": ("category_stats", ("category_name", "item_count")),
    "families_by_count": ("family_stats", ("platform_family_name", "item_count")),
    "category_groups_by_family": (
        "category_by_family", ("platform_family_name", "item_count", "category_group")),
    "rating_against_usage": (
        "rating_vs_usage", ("avg_usage_hrs", "avg_rating", "category_name")),
    "releases_per_year": ("release_trend", ("release_year", "item_count")),
    "content_rating_share": ("content_rating_dist", ("content_rating", "item_count")),
    "votes_by_title": ("vote_breakdown", ("vote_title", "total_votes")),
    "tags_by_count": ("top_tags", ("tag_name", "item_count")),
    "stores_by_count": ("store_dist", ("store_name", "item_count")),
    "rating_by_category": ("category_stats", ("category_name", "avg_rating")),
    "rating_by_family": ("family_stats", ("platform_family_name", "avg_rating")),
    "top_items_table": (
        "top_items",
        ("item_name", "released", "rating", "ratings_count", "usage_hrs", "content_rating")),
}


def feed(name: str, tables: Tables, params: Params = Params()) -> DataFrame:
    dataset, columns = FEEDS[name]
    return run(dataset, tables, params).select(*columns)
