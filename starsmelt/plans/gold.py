"""Silver to gold: a fact and bridges that carry names, and one top list."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.operators.joins import denormalise
from starsmelt.operators.quality import null_tokens_to_null
from starsmelt.sources.tables import Layout

# Gold bridge -> (silver bridge, silver dimension, id, name).
NAMED_BRIDGES = {
    "bridge_categories": (
        "bridge_item_categories", "dim_categories", "category_id", "category_name"),
    "bridge_platforms": (
        "bridge_item_platforms", "dim_platforms", "platform_id", "platform_name"),
    "bridge_platform_families": (
        "bridge_item_platform_families", "dim_platform_families",
        "platform_family_id", "platform_family_name"),
    "bridge_stores": ("bridge_item_stores", "dim_stores", "store_id", "store_name"),
}
FACT = "fact_items"
VOTES = "bridge_votes"
TOP_TAGS = "agg_top_tags"

GOLD_TABLES = (FACT, *NAMED_BRIDGES, VOTES, TOP_TAGS)

# Written with the tables, for the datasets: what changes only with a build is not found anew each time.
ITEM_TAGS = "index_item_tags"
LARGEST_CATEGORIES = "index_largest_categories"
GOLD_INDEXES = (ITEM_TAGS, LARGEST_CATEGORIES)
TOP_GROUPS = 5


def gold_fact(fact: DataFrame, content_ratings: DataFrame) -> DataFrame:
    """The fact with the name of its content rating, and year and month of release."""
    named = denormalise(fact, content_ratings, "content_rating_id")
    return named.withColumns({
        "release_year": F.year("released"),
        "release_month": F.month("released"),
    })


def top_tags(bridge: DataFrame, tags: DataFrame, size: int = 100) -> DataFrame:
    """The most used English tags by (id, name), counting bridge rows, ties by id and name.

    Counted per id before the join: repeats collapse map-side, so a tag on a third of all items is
    one row when it meets the dimension. Grouped before null cleaning, like every gold table.
    """
    english = tags.filter(F.col("tag_language") == "eng").select("tag_id", "tag_name")
    per_id = bridge.groupBy("tag_id").agg(F.count("item_id").alias("rows"))
    return (
        per_id.join(english, "tag_id")
        .groupBy("tag_id", "tag_name").agg(F.sum("rows").alias("item_count"))
        .orderBy(F.desc("item_count"), F.asc("tag_id"), F.asc("tag_name"))
        .limit(size)
    )


def item_tags(bridge: DataFrame, tags: DataFrame) -> DataFrame:
    """``item_id, tags``: the distinct names of an item's English tags, each in a struct, so that a NULL
    name stays. Names are uncleaned, and an id with two names gives both, as in a join of the tables.

    A list is bounded by one source record. The bridge is shuffled here, once a build, and no more. Rows
    move before they are grouped: after a join on the tag an item's lie apart, and merging finds nothing.
    """
    english = tags.filter(F.col("tag_language") == "eng").select("tag_id", "tag_name")
    named = bridge.join(english, "tag_id").select("item_id", "tag_name")
    return named.repartition("item_id").groupBy("item_id").agg(
        F.collect_set(F.struct("tag_name")).alias("tags"))


def largest_categories(bridge: DataFrame) -> DataFrame:
    """The names with the most items over the whole gold bridge; a NULL name takes a place."""
    return (
        bridge.groupBy("category_name").agg(F.count_distinct("item_id").alias("item_count"))
        .orderBy(F.desc("item_count"), F.asc("category_name")).limit(TOP_GROUPS)
    )


INDEX_BUILDERS = {ITEM_TAGS: item_tags, LARGEST_CATEGORIES: largest_categories}


def gold_table(name: str, silver: Mapping[str, DataFrame]) -> DataFrame:
    """Build one gold table, null tokens removed from its text columns, or one index."""
    if name == ITEM_TAGS:
        return item_tags(silver["bridge_item_tags"], silver["dim_tags"])
    if name == LARGEST_CATEGORIES:
        return largest_categories(gold_table("bridge_categories", silver))
    if name == FACT:
        built = gold_fact(silver["fact_items"], silver["dim_content_ratings"])
    elif name == VOTES:
        built = silver["bridge_item_votes"]
    elif name == TOP_TAGS:
        built = top_tags(silver["bridge_item_tags"], silver["dim_tags"])
    else:
        bridge, dim, key, _ = NAMED_BRIDGES[name]
        built = denormalise(silver[bridge], silver[dim], key)
    return null_tokens_to_null(built)


def build_gold(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven tables, lazy."""
    return {name: gold_table(name, silver) for name in GOLD_TABLES}


def build_indexes(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What is written along with the tables, lazy."""
    return {name: gold_table(name, silver) for name in GOLD_INDEXES}


def gold_layout(name: str, buckets: int | None) -> Layout:
    """Bucketed on the item; sorted on the column that filters: release date or name."""
    if name == FACT:
        return Layout("item_id", ("released",), buckets)
    if name in NAMED_BRIDGES:
        return Layout("item_id", (NAMED_BRIDGES[name][3],), buckets)
    if name == VOTES:
        return Layout("item_id", ("vote_title",), buckets)
    if name == ITEM_TAGS:
        return Layout("item_id", (), buckets)
    return Layout()
