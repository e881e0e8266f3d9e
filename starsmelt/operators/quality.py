"""Data quality: null tokens, duplicate keys, and reports of what was found."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsmelt.functions import null_token_to_null
from starsmelt.operators.membership import key_bitmap, mark_members
from starsmelt.schemas import NULL_TOKENS
from starsmelt.sources.stage import Stage


def null_tokens_to_null(
    df: DataFrame,
    tokens: Sequence[str] = NULL_TOKENS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Null-like text to NULL in every top-level string column (or in ``columns``).

    Strings inside arrays and structs are left alone. Applied to bronze before decoding, so a token
    inside JSON survives into silver and is nulled in gold only.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cleaned = set(columns)
    return df.select(*[
        null_token_to_null(F.col(name), tokens).alias(name) if name in cleaned else F.col(name)
        for name in df.columns
    ])


def _tie_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None) -> list:
    if order_by is None:
        order_by = [
            f.name for f in df.schema.fields
            if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))
        ]
    return [F.col(name).asc_nulls_last() for name in order_by]


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first by ``order_by`` (default: all other columns), nulls last.

    The survivor depends on content only, never on partitioning. NULL keys count as one key. Spark
    limits each key to its first row within every input task before the shuffle (the plan shows
    ``WindowGroupLimit`` twice), so a key with a third of all rows sends one row per task.
    """
    order = _tie_order(df, keys, order_by) or [F.col(keys[0])]
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``rows``. Reads the key columns only."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def mark_repeats(df: DataFrame, keys: Sequence[str], repeated: DataFrame) -> DataFrame:
    """``df`` with ``_copies``: ``one`` where the key is surely not among ``repeated``, else ``all``.

    One pass over the wide rows, which are not shuffled at any number of repeated keys: these become a
    bitmap of fixed size that is broadcast (:mod:`starsmelt.operators.membership`).
    """
    marked = mark_members(df, keys, key_bitmap(repeated, keys), "_again")
    copies = F.when(F.col("_again"), F.lit("all")).otherwise(F.lit("one")).alias("_copies")
    return marked.select(*[F.col(name) for name in df.columns], copies)


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    stage: Stage,
    order_by: Sequence[str] | None = None,
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Same rows as :func:`dedupe_by_key`, staged, ranking only rows whose key repeats.

    Wide records are dear to sort and few are duplicates. The repeated keys are found from the key
    columns alone. One pass over the wide rows then stages those whose key is surely unique, as they come;
    a second stages the first of each key among the others, where a unique key is the first of one. Both
    kinds written by one job would be sorted whole on their kind. ``derive``, which must leave the keys
    as they are, makes of chosen rows what is ranked and staged, so what it costs is paid once a row.
    The steps are the same at every size.
    """
    repeated = stage.put(duplicate_keys(df, keys).select(*keys), "duplicate_keys")
    marked = mark_repeats(df, keys, repeated)
    path = stage.path("unique")

    def of(kind: str) -> DataFrame:
        return derive(marked.filter(F.col("_copies") == kind).drop("_copies"))

    unique = of("one")
    stage.write(unique, f"{path}/unique")
    stage.write(dedupe_by_key(of("all"), keys, order_by), f"{path}/first")
    return df.sparkSession.read.schema(unique.schema).parquet(f"{path}/unique", f"{path}/first")


def dedupe_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``total_rows``, ``distinct_keys``, ``removed_rows``, in one pass over the keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("removed_rows", F.col("total_rows") - F.col("distinct_keys"))


def date_rejects(df: DataFrame, column: str) -> DataFrame:
    """One row: values of ``column`` that are text but no date."""
    bad = F.col(column).isNotNull() & F.try_to_date(F.col(column)).isNull()
    return df.agg(F.count_if(bad).alias("date_rejects"))


def dim_key_unique(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row in a dimension, with ``variants``; empty when all is well.

    Dimensions are distinct on all their columns, not on the key. A key with two names multiplies
    the rows of whatever joins it.
    """
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
