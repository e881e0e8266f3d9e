"""Operators: DataFrame in, DataFrame out."""

from starsmelt.operators.joins import denormalise
from starsmelt.operators.nested import (
    explode_bridge,
    explode_dimension,
    parse_json_columns,
    struct_dimension,
)
from starsmelt.operators.quality import (
    date_rejects,
    dedupe,
    dedupe_by_key,
    dedupe_report,
    dim_key_unique,
    duplicate_keys,
    null_tokens_to_null,
)
from starsmelt.operators.ranking import distinct_top

__all__ = [
    "date_rejects", "dedupe", "dedupe_by_key", "dedupe_report", "denormalise", "dim_key_unique",
    "distinct_top", "duplicate_keys", "explode_bridge", "explode_dimension",
    "null_tokens_to_null", "parse_json_columns", "struct_dimension",
]
