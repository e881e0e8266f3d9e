"""One selection over the datasets it narrows, evaluated together instead of one plan each.

Every item that the dates keep meets the lists of its names once, in its bucket, and gives an entry for
each chart and group that it counts in. The entries of all charts are added up by one grouping, whose
result, a row for each group of each chart, is staged; the datasets are projections of it. So the fact
and every bridge are read once for ten datasets, and what moves is grouped already. The list of top
items has rows of its own, not groups, and reads the fact a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsmelt.functions import stable_round
from starsmelt.operators.filters import NOT_RATED, Params, apply_filters
from starsmelt.plans.datasets import (
    DATASETS,
    DATES,
    FIRST_YEAR,
    OTHER,
    TOP_CATEGORIES,
    TOP_TAGS,
    Tables,
    index_table,
    narrowed,
    run,
)
from starsmelt.plans.gold import ITEM_TAGS, LARGEST_CATEGORIES
from starsmelt.sources import Stage

_ENTRY = "struct<chart:string,name:string,part:string,amount:bigint,counts:boolean>"
_HOURS = "kpi_hours"  # the groups that the median is found from
_MEASURES = ("rating", "usage_hrs", "ratings_count")
_NO_GROUPS = frozenset({"top_items"})


# Which fact rows stand for their item: of rows of one item, one that a chart takes counts it.
_OF_ITEM, _OF_USED, _OF_YEAR, _OF_RATING = "_of_item", "_of_used", "_of_year", "_of_rating"


def _entry(chart: str, name=None, part=None, amount=None, counts=None) -> Column:
    """``counts`` says whether the row adds an item to the group."""
    values = [F.lit(chart), *(F.lit(None) if x is None else x for x in (name, part, amount, counts))]
    return F.struct(*values).cast(_ENTRY)


def _listed(bridge: DataFrame, alias: str, *columns: str) -> DataFrame:
    """The rows of an item as one list in order, ``first`` where the name is; a NULL name joins no chart.

    A source record bounds the list.
    """
    named = bridge.filter(F.col(columns[0]).isNotNull())
    lists = named.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_list"))
    return lists.select("item_id", F.transform("_list", lambda row, at: F.struct(
        *[row[name].alias(name) for name in columns],
        ((at == 0) | (row[columns[0]] != F.get("_list", at - 1)[columns[0]])).alias("first"),
    )).alias(alias))


def _categories(tables: Tables) -> DataFrame:
    """``item_id, categories``: names with the group that each is shown in."""
    largest = index_table(tables, LARGEST_CATEGORIES, "gold.bridge_categories").select(
        F.col("category_name").alias("top_name"))
    bridge = tables["gold.bridge_categories"].select("item_id", "category_name")
    grouped = bridge.join(F.broadcast(largest), F.col("category_name") == F.col("top_name"), "left")
    return _listed(grouped.withColumn("category_group", F.coalesce("top_name", F.lit(OTHER))),
                   "categories", "category_name", "category_group")


def _families(tables: Tables) -> DataFrame:
    return _listed(tables["gold.bridge_platform_families"], "families", "platform_family_name")


def _stores(tables: Tables) -> DataFrame:
    return _listed(tables["gold.bridge_stores"], "stores", "store_name")


def _votes(tables: Tables) -> DataFrame:
    return _listed(tables["gold.bridge_votes"], "votes", "vote_title", "vote_count")


def _tags(tables: Tables) -> DataFrame:
    return index_table(tables, ITEM_TAGS, "silver.bridge_item_tags", "silver.dim_tags").select("item_id", "tags")


def _pairs() -> Column:
    """Each family of an item with each category group of it, once."""
    groups = F.array_distinct(F.transform("categories", lambda c: c["category_group"]))
    families = F.array_distinct(F.transform("families", lambda f: f["platform_family_name"]))
    return F.flatten(F.transform(groups, lambda group: F.transform(
        families, lambda family: _entry("category_by_family", family, group, counts=F.col(_OF_ITEM)))))


#: List -> how it is made; it is joined only if a chart or a filter needs it.
_LISTS = {"categories": _categories, "families": _families, "stores": _stores, "votes": _votes, "tags": _tags}
_NEEDS = {
    "category_stats": {"categories"}, "family_stats": {"families"}, "vote_breakdown": {"votes"},
    "top_tags": {"tags"}, "store_dist": {"stores"}, "rating_vs_usage": {"categories"},
    "category_by_family": {"categories", "families"},
}
_FILTER_NEEDS = {"category": "categories", "family": "families"}


def _entries(chart: str) -> Column:
    """What one fact row gives to a chart; NULL stands for nothing."""
    if chart == "kpi":  # counts rows
        both = F.array(_entry("kpi"), _entry(_HOURS, F.col("usage_hrs").cast("string")))
        return F.when(F.col("release_year").isNotNull(), both)

    def listed(column: str, name: str, of: str = _OF_ITEM) -> Column:
        return F.transform(column, lambda x: _entry(chart, x[name], counts=x["first"] & F.col(of)))

    if chart == "category_stats":
        return listed("categories", "category_name")
    if chart == "family_stats":
        return listed("families", "platform_family_name")
    if chart == "release_trend":
        shown = F.col("release_year").between(F.lit(FIRST_YEAR), F.year(F.current_date()))
        year = F.col("release_year").cast("string")
        return F.when(shown, F.array(_entry(chart, year, counts=F.col(_OF_YEAR))))
    if chart == "content_rating_dist":
        return F.array(_entry(chart, F.col("content_rating"), counts=F.col(_OF_RATING)))
    if chart == "vote_breakdown":  # adds up votes
        return F.transform("votes", lambda v: _entry(chart, v["vote_title"], amount=v["vote_count"]))
    if chart == "top_tags":  # a name is in the list of an item once
        return F.transform("tags", lambda t: _entry(chart, t["tag_name"], counts=F.col(_OF_ITEM)))
    if chart == "store_dist":
        return listed("stores", "store_name")
    if chart == "rating_vs_usage":
        return F.when(_used(), listed("categories", "category_name", _OF_USED))
    if chart == "category_by_family":
        return _pairs()
    raise KeyError(chart)


def _used() -> Column:
    return F.col("rating").isNotNull() & (F.col("usage_hrs") > 0)


def _marked(items: DataFrame, params: Params) -> DataFrame:
    """Fact rows with a mark of which of an item's rows counts it, for each kind of group.

    An item has several rows where the id of its content rating has several names. Rows that pass come
    first; whether an item passes by category or family is the same for all of them. The charts without
    the filter on content rating take every row, so any one may count. NULL is no item.
    """
    rating = params.content_rating
    passes = F.lit(True) if rating is None else F.coalesce("content_rating", F.lit(NOT_RATED)) == rating

    def first(rule: Column, *of: str) -> Column:
        place = F.row_number().over(Window.partitionBy("item_id", *of).orderBy(F.desc(rule), F.desc("content_rating")))
        return F.col("item_id").isNotNull() & (place == 1)

    return items.withColumns({
        _OF_ITEM: first(passes), _OF_USED: first(_used()),
        _OF_YEAR: first(passes, "release_year"), _OF_RATING: first(F.lit(True), "content_rating"),
    })


def _passes(params: Params) -> Column:
    """Whether an item passes the filters that only some datasets accept; the dates came before."""
    passes = F.lit(True)
    if params.content_rating is not None:
        passes &= F.coalesce("content_rating", F.lit(NOT_RATED)) == params.content_rating
    if params.category is not None:
        passes &= F.exists("categories", lambda c: c["category_name"] == params.category)
    if params.family is not None:
        passes &= F.exists("families", lambda f: f["platform_family_name"] == params.family)
    return passes


def grouped_entries(tables: Tables, params: Params, charts: list[str]) -> DataFrame:
    """``chart, name, part`` and the counts, means and sums of each group of each chart.

    An item counts once in a group, however many rows it has; means and sums take every row, as a join
    with the bridge would give it.

    The lists are merged with the items in their bucket at every size. The planner knows them by the size
    of the bridge's compressed files, and in memory they are many times that: below its threshold it would
    collect the lists of all items on the driver to broadcast them.
    """
    given = {name for name, value in vars(params).items() if value is not None}
    needed = set().union(*(_NEEDS.get(chart, set()) for chart in charts), *(
        {_FILTER_NEEDS[name]} for name in given & set(_FILTER_NEEDS)))
    items = apply_filters(tables["gold.fact_items"], tables, params, DATES).select(
        "item_id", "release_year", "content_rating", *_MEASURES)
    items = _marked(items, params)
    for name, build in _LISTS.items():
        if name in needed:
            items = items.join(build(tables).hint("merge"), "item_id", "left")
    nothing = F.array().cast(f"array<{_ENTRY}>")
    own = {chart: _passes(params.only(DATASETS[chart].accepts)) for chart in charts}
    entries = F.concat(*[
        F.coalesce(F.when(own[chart], _entries(chart)), nothing) for chart in charts])
    return (
        items.select(*_MEASURES, F.inline(entries))
        .groupBy("chart", "name", "part").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("counts").alias("item_count"),
            F.sum("amount").alias("amount"),
            *[F.avg(measure).alias(measure) for measure in _MEASURES])
    )


def _kpi(of, groups: DataFrame) -> DataFrame:
    """One row, also for no items. The lower median comes from the rows of each whole hour."""
    hours = of(_HOURS).filter("name IS NOT NULL").select(F.col("name").cast("bigint").alias("hours"), "rows")
    # one row for each hour value: few, so one task may order them
    upto = F.sum("rows").over(Window.orderBy("hours"))
    everything = F.sum("rows").over(Window.partitionBy())
    half = hours.filter("rows > 0").select("hours", (2 * upto >= everything).alias("reached"))
    median = half.agg(F.min(F.when(F.col("reached"), F.col("hours"))).alias("median"))
    found = of("kpi").select("rows", *_MEASURES, F.lit(None).cast("bigint").alias("median"))
    parts = found.unionByName(median, allowMissingColumns=True)
    return parts.agg(
        F.coalesce(F.max("rows"), F.lit(0).cast("bigint")).alias("total_items"),
        stable_round(F.max("rating"), 2).alias("avg_rating"),
        F.round(F.max("median").cast("double"), 1).alias("median_usage_hrs"),
        stable_round(F.max("ratings_count"), 0).alias("avg_ratings_count"),
    )


def _shown(chart: str, groups: DataFrame) -> DataFrame:
    """A dataset from its groups, with the columns, rounding and order that it has alone."""
    def of(name: str) -> DataFrame:
        return groups.filter(F.col("chart") == name)

    found, count = of(chart), F.col("item_count")
    rating = stable_round(F.col("rating"), 2).alias("avg_rating")
    usage = stable_round(F.col("usage_hrs"), 1).alias("avg_usage_hrs")
    if chart == "kpi":
        return _kpi(of, groups)
    if chart == "category_stats":
        return (found.select(F.col("name").alias("category_name"), count, rating, usage)
                .orderBy(F.desc("item_count"), "category_name").limit(TOP_CATEGORIES))
    if chart == "family_stats":
        return (found.select(F.col("name").alias("platform_family_name"), count, rating)
                .orderBy(F.desc("item_count"), "platform_family_name"))
    if chart == "release_trend":
        return (found.select(F.col("name").cast("int").alias("release_year"), count, rating)
                .orderBy("release_year"))
    if chart == "content_rating_dist":
        return (found.orderBy(F.desc("item_count"), "name")
                .select(F.coalesce("name", F.lit(NOT_RATED)).alias("content_rating"), count))
    if chart == "vote_breakdown":
        return (found.select(F.col("name").alias("vote_title"), F.col("amount").alias("total_votes"))
                .orderBy(F.desc("total_votes"), "vote_title"))
    if chart == "top_tags":
        return (found.select(F.col("name").alias("tag_name"), count)
                .orderBy(F.desc("item_count"), "tag_name").limit(TOP_TAGS))
    if chart == "store_dist":
        return (found.select(F.col("name").alias("store_name"), count)
                .orderBy(F.desc("item_count"), "store_name"))
    if chart == "rating_vs_usage":
        return found.select(F.col("name").alias("category_name"), rating, usage, count)
    if chart == "category_by_family":
        return (found.select(F.col("name").alias("platform_family_name"),
                             F.col("part").alias("category_group"), count)
                .orderBy("platform_family_name", F.desc("item_count"), "category_group"))
    raise KeyError(chart)


def apply_together(tables: Tables, params: Params, stage: Stage) -> dict[str, DataFrame]:
    """The datasets of :func:`starsmelt.plans.datasets.apply_to_all`, row for row, in one evaluation.

    The groups are computed and staged by the call and live as long as ``stage``; the datasets are then
    small reads. No filter set gives no dataset, as there.
    """
    names = narrowed(params)
    charts = [name for name in names if name not in _NO_GROUPS]
    if not charts:
        return {}
    groups = stage.put(grouped_entries(tables, params, charts), "groups")
    return {name: _shown(name, groups) if name in charts else run(name, tables, params) for name in names}
