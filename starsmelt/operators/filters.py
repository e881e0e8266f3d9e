"""The five optional filters on the gold fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: shown where an item has no content rating.
NOT_RATED = "Not Rated"


@dataclass(frozen=True)
class Params:
    """Filter values. None and ``''`` both mean "no filter"; so does a date text that is no date."""

    category: str | None = None
    family: str | None = None
    content_rating: str | None = None
    date_from: str | dt.date | None = None
    date_to: str | dt.date | None = None

    def __post_init__(self):
        for field in fields(self):
            if getattr(self, field.name) == "":
                object.__setattr__(self, field.name, None)

    def only(self, accepted: Collection[str]) -> Params:
        """The same values without those a dataset does not accept."""
        return Params(**{name: getattr(self, name) for name in accepted})


ALL_FILTERS = frozenset(field.name for field in fields(Params))


def _with_name(fact: DataFrame, bridge: DataFrame, column: str, value: str) -> DataFrame:
    return fact.join(bridge.filter(F.col(column) == value).select("item_id"), "item_id", "left_semi")


def _within(fact: DataFrame, bound: str | dt.date, lower: bool) -> DataFrame:
    # Spark decides whether the text is a date; the test folds to a constant in the plan.
    day = F.lit(bound).try_cast("date")
    released = F.col("released")
    return fact.filter(day.isNull() | (released >= day if lower else released <= day))


def apply_filters(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    params: Params,
    accepts: Collection[str] = ALL_FILTERS,
) -> DataFrame:
    """Fact rows that pass every filter that is set and accepted; unset ones add nothing.

    Category and family keep a row when the item has such a bridge row (a semi join on the item,
    so a popular name never multiplies rows). Date bounds are inclusive and drop unknown dates.
    """
    params = params.only(accepts)
    if params.date_from is not None:
        fact = _within(fact, params.date_from, lower=True)
    if params.date_to is not None:
        fact = _within(fact, params.date_to, lower=False)
    if params.content_rating is not None:
        shown = F.coalesce("content_rating", F.lit(NOT_RATED))
        fact = fact.filter(shown == params.content_rating)
    if params.category is not None:
        fact = _with_name(fact, tables["gold.bridge_categories"], "category_name", params.category)
    if params.family is not None:
        families = tables["gold.bridge_platform_families"]
        fact = _with_name(fact, families, "platform_family_name", params.family)
    return fact
