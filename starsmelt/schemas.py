"""Schemas of the bronze layer, as Spark DDL.

DDL text rather than ``StructType`` objects: readers and ``from_json`` take it as is, and building
it needs no running session.
"""

from __future__ import annotations

# Text that stands for "no value", compared after trimming spaces and lower-casing.
NULL_TOKENS = ("", "nan", "none", "null", "na", "n/a")

# Scalar fields of a source record.
SCALAR_FIELDS = {
    "id": "bigint",
    "name": "string",
    "released": "string",
    "tba": "boolean",
    "rating": "double",
    "ratings_count": "bigint",
    "reviews_text_count": "bigint",
    "reviews_count": "bigint",
    "added": "bigint",
    "playtime": "bigint",
}

# Nested fields of a source record that are decoded, with the parts that are kept.
NESTED_FIELDS = {
    "genres": "array<struct<id:bigint,name:string>>",
    "platforms": "array<struct<platform:struct<id:bigint,name:string>>>",
    "parent_platforms": "array<struct<platform:struct<id:bigint,name:string>>>",
    "stores": "array<struct<store:struct<id:bigint,name:string>>>",
    "tags": "array<struct<id:bigint,name:string,language:string>>",
    "ratings": "array<struct<id:bigint,title:string,count:bigint,percent:double>>",
    "added_by_status": "struct<yet:bigint,owned:bigint,beaten:bigint,toplay:bigint,"
                       "dropped:bigint,playing:bigint>",
    "esrb_rating": "struct<id:bigint,name:string>",
}

# Nested fields that stay JSON text.
OPAQUE_FIELDS = ("short_screenshots", "clip")

# Every nested field is one JSON string column in bronze.
ENCODED_FIELDS = (*NESTED_FIELDS, *OPAQUE_FIELDS)

BRONZE_FIELDS = {**SCALAR_FIELDS, **{name: "string" for name in ENCODED_FIELDS}}


def ddl(fields: dict[str, str]) -> str:
    """A ``{name: type}`` mapping as a DDL column list."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


BRONZE_SCHEMA = ddl(BRONZE_FIELDS)

# Source column -> (decoded column, schema).
DECODED_COLUMNS = {
    "genres": ("_categories", NESTED_FIELDS["genres"]),
    "platforms": ("_platforms", NESTED_FIELDS["platforms"]),
    "parent_platforms": ("_platform_families", NESTED_FIELDS["parent_platforms"]),
    "stores": ("_stores", NESTED_FIELDS["stores"]),
    "tags": ("_tags", NESTED_FIELDS["tags"]),
    "ratings": ("_votes", NESTED_FIELDS["ratings"]),
    "added_by_status": ("_status", NESTED_FIELDS["added_by_status"]),
    "esrb_rating": ("_content_rating", NESTED_FIELDS["esrb_rating"]),
}
