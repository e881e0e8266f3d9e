"""Catalogue records made from star-schema tables, by the rules of FIXTURES.md section 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsmelt.schemas import BRONZE_FIELDS, NESTED_FIELDS, SCALAR_FIELDS
from starsmelt.sources.pages import encode_nested

STAR_TABLES = ("orders", "lineitem", "part", "supplier", "nation", "region")


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sorted_set(element) -> F.Column:
    return F.sort_array(F.collect_set(element))


def _pair(id_col: str, name_col: str) -> F.Column:
    return F.struct(F.col(id_col).cast("bigint").alias("id"), F.col(name_col).alias("name"))


def _line_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order that has lines, holding the arrays of its record.

    The lines move to their order once, as narrow rows, and are grouped where they are: an order's
    lines lie apart in the input, so merging them before would sort every line and move nested buffers.
    What an order counts is a bit of a number from the start, so that wherever lines move it is as
    numbers. Structs are made after the move, in generated code, and wrapped in the member that holds
    them when they are sorted. ``collect_set`` keeps the distinct ids of one record, which is a single
    JSON value by definition, however many lines an order has.
    """
    counted = {
        **{f"flag_{flag}": F.col("l_returnflag") == flag for flag in "ANR"},
        **{f"status_{status}": F.col("l_linestatus") == status for status in "OF"},
        "no_discount": F.col("l_discount") == 0,
    }
    marks = sum((F.when(rule, 1 << bit).otherwise(0) for bit, rule in enumerate(counted.values())), F.lit(0))
    part = star_table(spark, folder, "part").select(
        "p_partkey", "p_name", F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint").alias("brand_id"),
        F.when(F.col("p_brand") == "Brand#25", "n/a").otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") % 3 == 0, True).otherwise(False).alias("russian"))
    supplier = star_table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    region = star_table(spark, folder, "region").select("r_regionkey", "r_name")
    nation = (
        star_table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", _pair("n_nationkey", "n_name").alias("platform"),
                _pair("r_regionkey", "r_name").alias("family"))
    )
    lines = (
        star_table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("hours"),
                marks.alias("marks"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .drop("l_partkey", "l_suppkey")
        .repartition("l_orderkey")
        .select(
            "l_orderkey", "hours", "marks", "s_nationkey",
            F.struct(F.col("brand_id").alias("id"), F.col("brand").alias("name")).alias("genre"),
            F.struct(
                F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                F.when(F.col("russian"), "rus").otherwise("eng").alias("language")).alias("tag"),
            _pair("s_suppkey", "s_name").alias("store"))
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    arrays = {  # array -> element, and the member that holds it
        "genres": ("genre", None), "platforms": ("platform", "platform"), "parent_platforms": ("family", "platform"),
        "stores": ("store", "store"), "tags": ("tag", None),
    }
    orders = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("hours").alias("hours"),
        *[F.count_if(F.col("marks").bitwiseAND(1 << bit) != 0).alias(name) for bit, name in enumerate(counted)],
        *[_sorted_set(element).alias(name) for name, (element, _) in arrays.items()],
    )

    def wrapped(name, member):
        return F.transform(name, lambda x: F.struct(x.alias(member)))

    return orders.withColumns({name: wrapped(name, member) for name, (_, member) in arrays.items() if member})


def records_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """One typed, nested record per order, and a second copy of some."""
    orders = star_table(spark, folder, "orders").join(
        _line_records(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    k = F.col("o_orderkey")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    votes = F.filter(
        F.array(*[
            F.struct(
                F.lit(vote_id).cast("bigint").alias("id"),
                F.lit(flag).alias("title"),
                F.col(f"flag_{flag}").alias("count"),
                (F.lit(100.0) * F.col(f"flag_{flag}") / F.col("n")).alias("percent"),
            )
            for vote_id, flag in ((1, "A"), (2, "N"), (3, "R"))
        ]),
        lambda vote: vote["count"] > 0,
    )

    def or_empty(name, column):
        empty = F.when(k % 2 == 0, F.from_json(F.lit("[]"), NESTED_FIELDS[name]))
        return F.when(F.col("n").isNotNull(), column).otherwise(empty).alias(name)

    rated = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    records = orders.select(
        k.alias("id"),
        F.when(k % 50 == 0, "N/A").when(k % 50 == 1, " none ").when(k % 50 == 2, "")
        .otherwise(F.concat(F.lit("Item#"), k)).alias("name"),
        F.when(k % 37 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("released"),
        (k % 37 == 0).alias("tba"),
        F.when(k % 41 != 0, F.col("o_totalprice") / 100000.0).alias("rating"),
        (n * 5).alias("ratings_count"),
        n.alias("reviews_text_count"),
        (n * 2).alias("reviews_count"),
        (n + k % 7).alias("added"),
        F.coalesce("hours", F.lit(0)).cast("bigint").alias("playtime"),
        or_empty("genres", F.col("genres")),
        or_empty("platforms", F.col("platforms")),
        or_empty("parent_platforms", F.col("parent_platforms")),
        or_empty("stores", F.col("stores")),
        or_empty("tags", F.col("tags")),
        or_empty("ratings", votes),
        F.when(F.col("n").isNotNull(), F.struct(
            F.col("status_O").alias("yet"), F.col("status_F").alias("owned"),
            F.col("flag_A").alias("beaten"), F.col("flag_N").alias("toplay"),
            F.col("flag_R").alias("dropped"), F.col("no_discount").alias("playing"),
        )).alias("added_by_status"),
        F.when(rated, F.struct(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id"),
            F.substring("o_orderpriority", 3, 100).alias("name"),
        )).alias("esrb_rating"),
    )
    copies = F.when(F.col("id") % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        records.withColumn("copy", F.explode(copies))
        .withColumn("added", F.col("added") + F.col("copy")).drop("copy")
    )


def odd_records(records: DataFrame) -> DataFrame:
    """The same records with what sources get wrong, by the rules of FIXTURES.md section 2.1."""
    k = F.col("id")
    alt = F.lit(" (alt)")

    def category(c):
        name = F.when(k % 59 == 0, F.concat(c["name"], alt)).otherwise(c["name"])
        number = F.when((k % 67 != 0) | (c["name"] != "Brand#7"), c["id"])
        return F.struct(number.alias("id"), name.alias("name"))

    genres = F.transform("genres", category)
    rating = F.col("esrb_rating")
    return records.withColumns({
        "released": F.when(k % 53 == 0, "2020-13-45").otherwise(F.col("released")),
        "genres": F.when(k % 61 == 0, F.concat(genres, genres)).otherwise(genres),
        "esrb_rating": F.when((k % 71 == 0) & rating.isNotNull(), F.struct(
            rating["id"].alias("id"), F.concat(rating["name"], alt).alias("name"))).otherwise(rating),
    })


def to_bronze(records: DataFrame) -> DataFrame:
    """Records in bronze form: nested fields as JSON text."""
    encoded = encode_nested(records, list(NESTED_FIELDS))
    return encoded.select(*[
        F.col(name) if name in SCALAR_FIELDS or name in NESTED_FIELDS
        else F.lit(None).cast("string").alias(name)
        for name in BRONZE_FIELDS
    ])


def items_from_star(spark: SparkSession, folder: str) -> DataFrame:
    return to_bronze(records_from_star(spark, folder))
