"""Bronze to silver: one fact, six dimensions, six bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.operators.nested import (
    explode_bridge,
    explode_dimension,
    parse_json_columns,
    struct_dimension,
)
from starsmelt.operators.quality import dedupe, null_tokens_to_null
from starsmelt.schemas import DECODED_COLUMNS, OPAQUE_FIELDS
from starsmelt.sources.stage import Stage
from starsmelt.sources.tables import Layout

FACT = "fact_items"
CONTENT_RATINGS = "dim_content_ratings"

# Table -> (decoded column, {output: path}); the first output is the id.
DIMENSIONS = {
    "dim_categories": ("_categories", {"category_id": "id", "category_name": "name"}),
    "dim_platforms": (
        "_platforms", {"platform_id": "platform.id", "platform_name": "platform.name"}),
    "dim_platform_families": (
        "_platform_families",
        {"platform_family_id": "platform.id", "platform_family_name": "platform.name"}),
    "dim_stores": ("_stores", {"store_id": "store.id", "store_name": "store.name"}),
    "dim_tags": ("_tags", {"tag_id": "id", "tag_name": "name", "tag_language": "language"}),
}

BRIDGES = {
    "bridge_item_categories": ("_categories", {"category_id": "id"}),
    "bridge_item_platforms": ("_platforms", {"platform_id": "platform.id"}),
    "bridge_item_platform_families": ("_platform_families", {"platform_family_id": "platform.id"}),
    "bridge_item_stores": ("_stores", {"store_id": "store.id"}),
    "bridge_item_tags": ("_tags", {"tag_id": "id"}),
    "bridge_item_votes": (
        "_votes",
        {"vote_id": "id", "vote_title": "title", "vote_count": "count", "vote_percent": "percent"}),
}

DIMENSION_KEYS = {
    CONTENT_RATINGS: "content_rating_id",
    **{name: next(iter(fields)) for name, (_, fields) in DIMENSIONS.items()},
}

SILVER_TABLES = (FACT, CONTENT_RATINGS, *DIMENSIONS, *BRIDGES)


def parsed_items(bronze: DataFrame, stage: Stage) -> DataFrame:
    """Clean, de-duplicated, decoded records, staged once for all thirteen tables.

    Each table then scans the one nested column it needs instead of decoding JSON again, and all
    tables see the same survivor of each duplicate key.
    """
    def decoded(rows: DataFrame) -> DataFrame:
        return parse_json_columns(null_tokens_to_null(rows), DECODED_COLUMNS)

    return dedupe(bronze.drop(*OPAQUE_FIELDS), ["id"], stage, derive=decoded)


def fact_items(parsed: DataFrame) -> DataFrame:
    """One row per item. Text that is no date becomes NULL; ``date_rejects`` counts such rows."""
    # Members of the status object.
    status = ("yet", "owned", "beaten", "toplay", "dropped", "playing")
    return parsed.select(
        F.col("id").alias("item_id"),
        F.col("name").alias("item_name"),
        F.try_to_date(F.col("released")).alias("released"),
        "tba",
        "rating",
        "ratings_count",
        "reviews_text_count",
        "reviews_count",
        "added",
        F.col("playtime").alias("usage_hrs"),
        *[F.col(f"_status.{name}").alias(f"added_{name}") for name in status],
        F.col("_content_rating.id").alias("content_rating_id"),
    )


def silver_table(name: str, parsed: DataFrame) -> DataFrame:
    """Build one silver table from the staged records."""
    if name == FACT:
        return fact_items(parsed)
    if name == CONTENT_RATINGS:
        fields = {"content_rating_id": "id", "content_rating": "name"}
        return struct_dimension(parsed, "_content_rating", fields, "content_rating_id")
    if name in DIMENSIONS:
        column, fields = DIMENSIONS[name]
        return explode_dimension(parsed, column, fields, next(iter(fields)))
    column, fields = BRIDGES[name]
    return explode_bridge(parsed, ("id", "item_id"), column, fields, next(iter(fields)))


def build_silver(bronze: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    """All thirteen tables; staging happens here, the tables themselves are lazy."""
    parsed = parsed_items(bronze, stage)
    return {name: silver_table(name, parsed) for name in SILVER_TABLES}


def silver_layout(name: str, buckets: int | None) -> Layout:
    """Plain: silver feeds the gold build, which lays its own tables out; bucketing here as well would
    shuffle the same rows twice."""
    return Layout()
