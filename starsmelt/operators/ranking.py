"""Order statistics that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups over which equal rows are spread; each task sends at most ``size`` distinct rows to each.
GROUPS = 32


def distinct_top(
    df: DataFrame, columns: Sequence[str], order: Sequence[Column], size: int, spread_by: str
) -> DataFrame:
    """The first ``size`` distinct rows of ``columns`` by ``order``, a total order over them.

    Rows fall into groups by the hash of ``spread_by``, so copies of one row are spread too. Within
    a group only rows up to the ``size``-th distinct one can be in the result. Spark applies that
    limit within every task before the shuffle (``WindowGroupLimit``) and again after it; what is
    left is made distinct, map-side first.
    """
    grouped = df.select(*columns, F.pmod(F.xxhash64(spread_by), F.lit(GROUPS)).alias("_group"))
    place = F.dense_rank().over(Window.partitionBy("_group").orderBy(*order))
    kept = grouped.withColumn("_place", place).filter(F.col("_place") <= size)
    return kept.select(*columns).distinct().orderBy(*order).limit(size)
