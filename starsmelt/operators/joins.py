"""Joins with a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame


def denormalise(rows: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left join that adds the other columns of ``dim`` to ``rows``; unmatched rows keep NULLs.

    No hint: ``dim`` is a written table, so the planner knows its size, broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and sorts both sides beyond. Adaptive execution then
    splits a key (NULL among them) that holds too many rows of the left side.
    """
    dim_key = dim_key or key
    renamed = dim.withColumnRenamed(dim_key, "_dim_key")
    return rows.join(renamed, rows[key] == renamed["_dim_key"], "left").drop("_dim_key")
