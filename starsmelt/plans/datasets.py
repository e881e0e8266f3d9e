"""The fourteen datasets: three option lists and eleven filtered aggregates.

A dataset takes the tables (``"gold.fact_items"`` -> DataFrame) and the parameters. The filters it
does not accept are ignored: a chart of a dimension is not narrowed by its own filter. Every top
list ends in a total order, so ties do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.functions import stable_round
from starsmelt.operators.filters import ALL_FILTERS, NOT_RATED, Params, apply_filters
from starsmelt.operators.ranking import distinct_top
from starsmelt.plans.gold import INDEX_BUILDERS, ITEM_TAGS, LARGEST_CATEGORIES

Tables = Mapping[str, DataFrame]

# Fixed values of the charts.
FIRST_YEAR = 1990
MIN_RATINGS = 10
TOP_CATEGORIES, TOP_TAGS, TOP_ITEMS = 15, 10, 20
OTHER = "Other"


@dataclass(frozen=True)
class Dataset:
    build: Callable[[Tables, Params], DataFrame]
    accepts: frozenset[str]


DATASETS: dict[str, Dataset] = {}


def _dataset(name: str, accepts: frozenset[str] = frozenset()):
    def register(build):
        DATASETS[name] = Dataset(build, accepts)
        return build
    return register


def _fact(tables: Tables, params: Params, name: str) -> DataFrame:
    return apply_filters(tables["gold.fact_items"], tables, params, DATASETS[name].accepts)


def index_table(tables: Tables, name: str, *sources: str) -> DataFrame:
    """What the gold build wrote along with its tables, or the same rows made now from tables without it."""
    try:
        return tables[f"gold.{name}"]
    except KeyError:
        return INDEX_BUILDERS[name](*[tables[source] for source in sources])


DATES = frozenset({"date_from", "date_to"})
ITEM_COUNT = F.count_distinct  # items are counted once per group, however many rows they have


# Option lists

@_dataset("opt_categories")
def opt_categories(tables, params):
    names = tables["gold.bridge_categories"].select("category_name")
    return names.filter("category_name IS NOT NULL").distinct().orderBy("category_name")


@_dataset("opt_families")
def opt_families(tables, params):
    names = tables["gold.bridge_platform_families"].select("platform_family_name")
    return names.filter("platform_family_name IS NOT NULL").distinct().orderBy("platform_family_name")


@_dataset("opt_content_ratings")
def opt_content_ratings(tables, params):
    shown = F.coalesce("content_rating", F.lit(NOT_RATED)).alias("content_rating")
    return tables["gold.fact_items"].select(shown).distinct().orderBy("content_rating")


# Aggregates

@_dataset("kpi", ALL_FILTERS)
def kpi(tables, params):
    """One row, one pass. The exact lower median keeps a count per distinct whole hour in each task."""
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY usage_hrs)")
    return _fact(tables, params, "kpi").filter("release_year IS NOT NULL").agg(
        F.count(F.lit(1)).alias("total_items"),
        stable_round(F.avg("rating"), 2).alias("avg_rating"),
        F.round(median.cast("double"), 1).alias("median_usage_hrs"),
        stable_round(F.avg("ratings_count"), 0).alias("avg_ratings_count"),
    )


@_dataset("category_stats", ALL_FILTERS - {"category"})
def category_stats(tables, params):
    items = _fact(tables, params, "category_stats").select("item_id", "rating", "usage_hrs")
    categories = tables["gold.bridge_categories"].select("item_id", "category_name")
    return (
        items.join(categories.filter("category_name IS NOT NULL"), "item_id")
        .groupBy("category_name").agg(
            ITEM_COUNT("item_id").alias("item_count"),
            stable_round(F.avg("rating"), 2).alias("avg_rating"),
            stable_round(F.avg("usage_hrs"), 1).alias("avg_usage_hrs"),
        )
        .orderBy(F.desc("item_count"), "category_name").limit(TOP_CATEGORIES)
    )


@_dataset("family_stats", ALL_FILTERS - {"family"})
def family_stats(tables, params):
    items = _fact(tables, params, "family_stats").select("item_id", "rating")
    families = tables["gold.bridge_platform_families"].select("item_id", "platform_family_name")
    return (
        items.join(families.filter("platform_family_name IS NOT NULL"), "item_id")
        .groupBy("platform_family_name").agg(
            ITEM_COUNT("item_id").alias("item_count"),
            stable_round(F.avg("rating"), 2).alias("avg_rating"),
        )
        .orderBy(F.desc("item_count"), "platform_family_name")
    )


@_dataset("release_trend", ALL_FILTERS)
def release_trend(tables, params, as_of_year: int | None = None):
    last = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    return (
        _fact(tables, params, "release_trend")
        .filter(F.col("release_year").between(F.lit(FIRST_YEAR), last))
        .groupBy("release_year").agg(
            ITEM_COUNT("item_id").alias("item_count"),
            stable_round(F.avg("rating"), 2).alias("avg_rating"),
        )
        .orderBy("release_year")
    )


@_dataset("content_rating_dist", ALL_FILTERS - {"content_rating"})
def content_rating_dist(tables, params):
    """Grouped on the stored name: NULL and a literal 'Not Rated' are two rows with one label."""
    return (
        _fact(tables, params, "content_rating_dist")
        .groupBy("content_rating").agg(ITEM_COUNT("item_id").alias("item_count"))
        .orderBy(F.desc("item_count"), "content_rating")
        .select(F.coalesce("content_rating", F.lit(NOT_RATED)).alias("content_rating"), "item_count")
    )


@_dataset("vote_breakdown", ALL_FILTERS)
def vote_breakdown(tables, params):
    items = _fact(tables, params, "vote_breakdown").select("item_id")
    votes = tables["gold.bridge_votes"].select("item_id", "vote_title", "vote_count")
    return (
        votes.filter("vote_title IS NOT NULL").join(items, "item_id")
        .groupBy("vote_title").agg(F.sum("vote_count").alias("total_votes"))
        .orderBy(F.desc("total_votes"), "vote_title")
    )


@_dataset("top_tags", ALL_FILTERS)
def top_tags(tables, params):
    """By tag name: ids that share a name merge, names are uncleaned.

    The lists of the items that pass are spread out in place. An item has a name once, so rows are
    items, and what moves is counted already.
    """
    items = _fact(tables, params, "top_tags").select("item_id")
    lists = index_table(tables, ITEM_TAGS, "silver.bridge_item_tags", "silver.dim_tags").join(
        items, "item_id", "left_semi")
    return (
        lists.select(F.inline("tags"))
        .groupBy("tag_name").agg(F.count(F.lit(1)).alias("item_count"))
        .orderBy(F.desc("item_count"), "tag_name").limit(TOP_TAGS)
    )


@_dataset("store_dist", ALL_FILTERS)
def store_dist(tables, params):
    items = _fact(tables, params, "store_dist").select("item_id")
    stores = tables["gold.bridge_stores"].select("item_id", "store_name")
    return (
        stores.filter("store_name IS NOT NULL").join(items, "item_id", "left_semi")
        .groupBy("store_name").agg(ITEM_COUNT("item_id").alias("item_count"))
        .orderBy(F.desc("item_count"), "store_name")
    )


@_dataset("top_items", ALL_FILTERS)
def top_items(tables, params):
    """Distinct rows, ordered on the unrounded rating."""
    rated = (
        _fact(tables, params, "top_items")
        .filter((F.col("ratings_count") >= MIN_RATINGS) & F.col("rating").isNotNull())
    )
    shown = ["item_name", "released", "rating", "ratings_count", "usage_hrs", "content_rating"]
    order = [
        F.desc("rating"), F.desc("ratings_count"), F.asc("item_name"), F.asc("released"),
        F.asc("usage_hrs"), F.asc("content_rating"),
    ]
    return distinct_top(rated, shown, order, TOP_ITEMS, spread_by="item_id").select(
        "item_name",
        F.col("released").cast("string").alias("released"),
        stable_round(F.col("rating"), 2).alias("rating"),
        "ratings_count",
        "usage_hrs",
        F.coalesce("content_rating", F.lit(NOT_RATED)).alias("content_rating"),
    )


@_dataset("rating_vs_usage", DATES)
def rating_vs_usage(tables, params):
    items = (
        _fact(tables, params, "rating_vs_usage")
        .filter("rating IS NOT NULL AND usage_hrs > 0").select("item_id", "rating", "usage_hrs")
    )
    categories = tables["gold.bridge_categories"].select("item_id", "category_name")
    return (
        items.join(categories.filter("category_name IS NOT NULL"), "item_id")
        .groupBy("category_name").agg(
            stable_round(F.avg("rating"), 2).alias("avg_rating"),
            stable_round(F.avg("usage_hrs"), 1).alias("avg_usage_hrs"),
            ITEM_COUNT("item_id").alias("item_count"),
        )
    )


@_dataset("category_by_family", DATES)
def category_by_family(tables, params):
    """Items per family and category group: the five largest categories of all items, or 'Other'.

    The five are taken over the whole bridge, whatever the dates, by the gold build; a NULL name takes
    a place.
    Categories shrink to at most six groups per item before they meet the families, and both sides
    are distinct per item, so the counting needs no second pass over the joined rows.
    """
    categories = tables["gold.bridge_categories"].select("item_id", "category_name")
    largest = index_table(tables, LARGEST_CATEGORIES, "gold.bridge_categories").select(
        F.col("category_name").alias("top_name"))
    groups = (
        categories.filter("category_name IS NOT NULL")
        .join(F.broadcast(largest), F.col("category_name") == F.col("top_name"), "left")
        .select("item_id", F.coalesce("top_name", F.lit(OTHER)).alias("category_group"))
        .distinct()
    )
    families = (
        tables["gold.bridge_platform_families"].select("item_id", "platform_family_name")
        .filter("platform_family_name IS NOT NULL").distinct()
    )
    items = _fact(tables, params, "category_by_family").select("item_id")
    return (
        groups.join(items, "item_id", "left_semi").join(families, "item_id")
        .groupBy("platform_family_name", "category_group")
        .agg(F.count(F.lit(1)).alias("item_count"))
        .orderBy("platform_family_name", F.desc("item_count"), "category_group")
    )


def run(name: str, tables: Tables, params: Params = Params()) -> DataFrame:
    return DATASETS[name].build(tables, params)


def targets(param: str) -> list[str]:
    """The datasets that a parameter narrows."""
    return [name for name, dataset in DATASETS.items() if param in dataset.accepts]


def narrowed(params: Params) -> list[str]:
    """The datasets that accept at least one of the filters that are set."""
    given = {name for name, value in vars(params).items() if value is not None}
    return [name for name, dataset in DATASETS.items() if given & dataset.accepts]


def apply_to_all(tables: Tables, params: Params) -> dict[str, DataFrame]:
    """One selection over every dataset that it narrows, a plan each."""
    return {name: run(name, tables, params) for name in narrowed(params)}
