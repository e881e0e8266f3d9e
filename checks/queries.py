"""Registered queries: name -> (spark, folder of star tables) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.workbench import workbench
from starsmelt.fixtures import star_table
from starsmelt.operators import (
    date_rejects,
    dedupe_by_key,
    dedupe_report,
    dim_key_unique,
    null_tokens_to_null,
    parse_json_columns,
)
from starsmelt.operators.filters import Params, apply_filters
from starsmelt.plans.datasets import DATASETS, apply_to_all, run
from starsmelt.plans.feeds import FEEDS, feed
from starsmelt.plans.gold import GOLD_TABLES
from starsmelt.plans.medallion import MedallionTables, load_bronze, quality_report
from starsmelt.plans.selection import apply_together
from starsmelt.plans.silver import DIMENSION_KEYS, SILVER_TABLES
from starsmelt.schemas import BRONZE_SCHEMA, DECODED_COLUMNS, SCALAR_FIELDS
from starsmelt.sources import (
    encode_nested,
    load_table,
    read_pages,
    read_parquet,
    read_table,
    write_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameter sets of FIXTURES.md section 4.
P1 = Params(category="Brand#4")
P2 = Params(family="ASIA")
P3 = Params(content_rating="Not Rated")
P4_FROM = Params(date_from="1996-01-01")
P4_TO = Params(date_to="1999-12-31")
P4 = Params(date_from="1996-01-01", date_to="1999-12-31")
P5 = Params("Brand#4", "ASIA", "Not Rated", "1996-01-01", "1999-12-31")

FILTERS = {
    "filter_category": P1,
    "filter_family": P2,
    "filter_content_rating": P3,
    "filter_date_from": P4_FROM,
    "filter_date_to": P4_TO,
    "filter_all": P5,
}
ITEM_COLUMNS = ("item_id", "item_name", "released", "rating", "usage_hrs", "content_rating")
LINE_KEY = ("l_orderkey", "l_linenumber")


def page_flatten(spark, folder):
    bench = workbench(spark, folder)
    records = read_pages(spark, bench.pages)
    return records.select(*SCALAR_FIELDS, F.col("genres").isNotNull().alias("has_genres"))


def json_round_trip(spark, folder):
    bench = workbench(spark, folder)
    encoded = encode_nested(bench.records_once, list(DECODED_COLUMNS))
    decoded = bench.stage.put(parse_json_columns(encoded, DECODED_COLUMNS), "round_trip")
    sizes = {
        "categories": "_categories", "platforms": "_platforms", "families": "_platform_families",
        "stores": "_stores", "tags": "_tags",
    }
    return decoded.select(
        "id", "added",
        *[F.size(column).alias(f"n_{name}") for name, column in sizes.items()],
        "_status.*", F.col("_content_rating.id").alias("content_rating_id"),
        F.explode("_votes").alias("vote"),
    ).select(
        "*", F.col("vote.id").alias("vote_id"), F.col("vote.title").alias("vote_title"),
        F.col("vote.count").alias("vote_count"), F.col("vote.percent").alias("vote_percent"),
    ).drop("vote")


def parquet_bronze_scan(spark, folder):
    bench = workbench(spark, folder)
    path = bench.stage.path("copy")
    write_parquet(bench.bronze, path)
    return read_parquet(spark, path, BRONZE_SCHEMA).select(*SCALAR_FIELDS)


def bronze_table_load(spark, folder):
    bench = workbench(spark, folder)
    target, path = bench.new_target(), bench.stage.path("records")
    write_parquet(bench.bronze, path)
    load_table(target.layer(spark, "bronze"), path, "items", BRONZE_SCHEMA)
    return read_table(spark, target.table("bronze", "items")).select("id", "name", "released", "rating", "added", "playtime")


def null_tokens(spark, folder):
    cleaned = null_tokens_to_null(workbench(spark, folder).bronze)
    return cleaned.select("id", "name", "released", "added")


def lineitem_dedupe(spark, folder):
    return dedupe_by_key(star_table(spark, folder, "lineitem"), LINE_KEY)


def lineitem_dedupe_report(spark, folder):
    return dedupe_report(star_table(spark, folder, "lineitem"), LINE_KEY)


def props_json_parse(spark, folder):
    events = star_table(spark, folder, "events").select("event_id", "props")
    parsed = parse_json_columns(events, {"props": ("_props", "struct<k:bigint>")})
    return parsed.select("event_id", F.col("_props.k").alias("k"))


def rejected_dates(spark, folder):
    return date_rejects(workbench(spark, folder).bronze, "released")


def _one_row_each(frames: Mapping[str, DataFrame], label: str, count: str) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dim_key_violations(spark, folder):
    bench = workbench(spark, folder)
    return _one_row_each(
        {name: dim_key_unique(bench[f"silver.{name}"], key) for name, key in DIMENSION_KEYS.items()},
        "dimension", "keys_with_variants")


def silver_write_all(spark, folder):
    bench = workbench(spark, folder)
    return _one_row_each({n: bench[f"silver.{n}"] for n in SILVER_TABLES}, "table_name", "row_count")


def gold_write_all(spark, folder):
    bench = workbench(spark, folder)
    return _one_row_each({n: bench[f"gold.{n}"] for n in GOLD_TABLES}, "table_name", "row_count")


def medallion_end_to_end(spark, folder):
    return run("kpi", workbench(spark, folder).end_to_end)


def medallion_quality_report(spark, folder):
    return quality_report(workbench(spark, folder).end_to_end)


def apply_to_all_rows(spark, folder):
    return _one_row_each(apply_to_all(workbench(spark, folder), P5), "dataset", "row_count")


def _as_text(df: DataFrame) -> F.Column:
    return F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in df.columns])


def _content(found: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("dataset"), _as_text(df).alias("content")) for name, df in found.items()])


def apply_to_all_content(spark, folder):
    """Every row of every dataset that one selection narrows, as text."""
    return _content(apply_to_all(workbench(spark, folder), P5))


def _together(params: Params) -> Query:
    """The same rows from one evaluation of all datasets."""
    def query(spark, folder):
        bench = workbench(spark, folder)
        return _content(apply_together(bench, params, bench.stage))
    return query


def bronze_content(spark, folder):
    """Every element that the JSON columns of bronze hold, read back from the text."""
    decoded = parse_json_columns(workbench(spark, folder).bronze, DECODED_COLUMNS)

    def listed(column: str, *fields: str):
        def element(x):
            values = [reduce(lambda value, part: value[part], field.split("."), x) for field in fields]
            return F.concat_ws(":", *[F.coalesce(v.cast("string"), F.lit("~")) for v in values])
        return F.array_join(F.array_sort(F.transform(column, element)), ";")

    return decoded.select(
        *SCALAR_FIELDS, listed("_categories", "id", "name").alias("categories"),
        listed("_platforms", "platform.id", "platform.name").alias("platforms"),
        listed("_platform_families", "platform.id", "platform.name").alias("families"),
        listed("_stores", "store.id", "store.name").alias("stores"),
        listed("_tags", "id", "name", "language").alias("tags"),
        listed("_votes", "id", "title", "count").alias("votes"),
        F.col("_status.yet").alias("yet"), F.col("_status.owned").alias("owned"),
        F.col("_status.beaten").alias("beaten"), F.col("_status.toplay").alias("toplay"),
        F.col("_status.dropped").alias("dropped"), F.col("_status.playing").alias("playing"),
        F.col("_content_rating.id").alias("content_rating_id"),
        F.col("_content_rating.name").alias("content_rating"),
        (F.col("short_screenshots").isNull() & F.col("clip").isNull()).alias("no_media"))


def gates(spark, folder):
    """What a load from bad input raises, and the rows that the table still has."""
    bench = workbench(spark, folder)
    target = bench.new_target()
    bench.records  # staged, since pages and bronze are both made of them
    load_bronze(spark, bench.pages, target)
    lacking, bare, pages = (bench.stage.path(name) for name in ("lacking", "bare", "no_pages"))
    write_parquet(bench.bronze.drop("genres"), lacking)
    write_parquet(bench.bronze.filter("id IS NULL AND id IS NOT NULL"), bare)
    bench.bronze.filter("false").selectExpr("name").write.text(pages)
    rows = []
    for case, source, kind, expected in (
            ("no_rows", bare, "parquet", None), ("no_pages", pages, "pages", None),
            ("missing_path", f"{bare}/nowhere", "parquet", None), ("missing_pages", f"{bare}/nowhere", "pages", None),
            ("absent_column", lacking, "parquet", None), ("too_few_pages", bench.pages, "pages", 10**12)):
        try:
            load_bronze(spark, source, target, kind, expected)
            raised = "nothing"
        except Exception as failure:
            raised = type(failure).__name__
        left = MedallionTables(spark, target)["bronze.items"]
        rows.append(left.agg(F.count(F.lit(1)).alias("rows_left")).select(
            F.lit(case).alias("input"), F.lit(raised).alias("raised"), "rows_left"))
    return reduce(DataFrame.unionByName, rows)


def rejected_pages(spark, folder):
    """Records and rejects of a load that skips bad pages: one cut off page for every thousandth id."""
    bench = workbench(spark, folder)
    target, path = bench.new_target(), bench.stage.path("some_bad")
    cut_off = bench.records.filter("id % 1000 = 0").select(
        F.concat(F.lit('{"results":[{"id":'), F.col("id").cast("string"), F.lit(',"name":')).alias("value"))
    spark.read.text(bench.pages).unionByName(cut_off).write.option("compression", "gzip").text(path)
    load_bronze(spark, path, target, max_bad_pages=10**9)
    tables = MedallionTables(spark, target)
    return tables["bronze.items"].select("id", "name", "rating").unionByName(
        tables["bronze.rejected_pages"], allowMissingColumns=True)


def odd_dim_key_violations(spark, folder):
    bench = workbench(spark, folder, odd=True)
    return _one_row_each(
        {name: dim_key_unique(bench[f"silver.{name}"], key) for name, key in DIMENSION_KEYS.items()},
        "dimension", "keys_with_variants")


def odd_quality_report(spark, folder):
    return quality_report(workbench(spark, folder, odd=True).end_to_end)


def feed_all(spark, folder):
    bench = workbench(spark, folder)
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("feed"), F.lit(",".join(df.columns)).alias("columns"), "row_count")
        for name, df in ((name, feed(name, bench)) for name in FEEDS)
    ]
    return reduce(DataFrame.unionByName, rows)


def _silver(name: str) -> Query:
    return lambda spark, folder: workbench(spark, folder).build_silver(name)


def _gold(name: str) -> Query:
    return lambda spark, folder: workbench(spark, folder).build_gold(name)


def _filter(params: Params) -> Query:
    def filtered(spark, folder):
        bench = workbench(spark, folder)
        return apply_filters(bench["gold.fact_items"], bench, params).select(*ITEM_COLUMNS)
    return filtered


def _dataset(name: str, params: Params = Params()) -> Query:
    return lambda spark, folder: run(name, workbench(spark, folder), params)


def _feed(name: str) -> Query:
    return lambda spark, folder: feed(name, workbench(spark, folder))


def _odd_silver(name: str) -> Query:
    return lambda spark, folder: workbench(spark, folder, odd=True).build_silver(name)


def _odd_gold(name: str) -> Query:
    return lambda spark, folder: workbench(spark, folder, odd=True).build_gold(name)


def _odd_dataset(name: str) -> Query:
    return lambda spark, folder: run(name, workbench(spark, folder, odd=True))


# Tables and datasets that the odd records change.
ODD_SILVER = ("fact_items", "dim_categories", "dim_content_ratings", "bridge_item_categories")
ODD_GOLD = ("fact_items", "bridge_categories")
ODD_DATASETS = ("kpi", "category_stats", "content_rating_dist", "category_by_family", "top_tags")

QUERIES: dict[str, Query] = {
    "page_flatten": page_flatten,
    "json_round_trip": json_round_trip,
    "parquet_bronze_scan": parquet_bronze_scan,
    "bronze_table_load": bronze_table_load,
    "null_tokens": null_tokens,
    "dedupe_by_key": lineitem_dedupe,
    "dedupe_report": lineitem_dedupe_report,
    "props_json_parse": props_json_parse,
    "date_rejects": rejected_dates,
    "dim_key_violations": dim_key_violations,
    **{f"silver_{name}": _silver(name) for name in SILVER_TABLES},
    "silver_write_all": silver_write_all,
    **{f"gold_{name}": _gold(name) for name in GOLD_TABLES},
    "gold_write_all": gold_write_all,
    **{name: _filter(params) for name, params in FILTERS.items()},
    **{name: _dataset(name) for name in DATASETS},
    **{f"{name}_filtered": _dataset(name, P5) for name, ds in DATASETS.items() if ds.accepts},
    "apply_to_all": apply_to_all_rows,
    "apply_to_all_content": apply_to_all_content,
    "apply_together_filtered": _together(P5),
    "apply_together_dates": _together(P4),
    "bronze_content": bronze_content,
    "gates": gates,
    "rejected_pages": rejected_pages,
    **{f"odd_silver_{name}": _odd_silver(name) for name in ODD_SILVER},
    **{f"odd_gold_{name}": _odd_gold(name) for name in ODD_GOLD},
    **{f"odd_{name}": _odd_dataset(name) for name in ODD_DATASETS},
    "odd_dim_key_violations": odd_dim_key_violations,
    "odd_quality_report": odd_quality_report,
    **{f"feed_{name}": _feed(name) for name in FEEDS},
    "feed_all": feed_all,
    "medallion_end_to_end": medallion_end_to_end,
    "quality_report": medallion_quality_report,
}
