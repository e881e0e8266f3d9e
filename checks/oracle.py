"""DuckDB SQL for every registered query, written on the raw star tables.

Nothing here goes through JSON, so agreement also checks encoding, decoding and exploding.
"""

from __future__ import annotations


def _clean(expr: str) -> str:
    return (f"CASE WHEN lower(trim({expr})) IN ('', 'nan', 'none', 'null', 'na', 'n/a') "
            f"THEN NULL ELSE {expr} END")


def _round(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


_NAME = ("CASE o_orderkey % 50 WHEN 0 THEN 'N/A' WHEN 1 THEN ' none ' WHEN 2 THEN '' "
         "ELSE 'Item#' || o_orderkey END")
_RELEASED = "CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END"

BASE = f"""
WITH lines AS (
  SELECT l.*, p_name, p_brand, p_size, s_suppkey, s_name, n_nationkey, n_name, r_regionkey, r_name
  FROM lineitem l
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
), per_item AS (
  SELECT l_orderkey AS k, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS hours,
    count(*) FILTER (WHERE l_returnflag = 'A') AS flag_a,
    count(*) FILTER (WHERE l_returnflag = 'N') AS flag_n,
    count(*) FILTER (WHERE l_returnflag = 'R') AS flag_r,
    count(*) FILTER (WHERE l_linestatus = 'O') AS status_o,
    count(*) FILTER (WHERE l_linestatus = 'F') AS status_f,
    count(*) FILTER (WHERE l_discount = 0) AS no_discount
  FROM lines GROUP BY l_orderkey
), every_record AS (
  SELECT o_orderkey AS id, {_NAME} AS name, {_RELEASED} AS released,
    o_orderkey % 37 = 0 AS tba,
    CASE WHEN o_orderkey % 41 <> 0 THEN o_totalprice / 100000.0::DOUBLE END AS rating,
    coalesce(n, 0) * 5 AS ratings_count, coalesce(n, 0) AS reviews_text_count,
    coalesce(n, 0) * 2 AS reviews_count, coalesce(n, 0) + o_orderkey % 7 AS added,
    coalesce(hours, 0) AS playtime,
    n, flag_a, flag_n, flag_r, status_o, status_f, no_discount,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
      THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS content_rating_id,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
      THEN substr(o_orderpriority, 3) END AS content_rating
  FROM orders LEFT JOIN per_item ON o_orderkey = k
), bronze AS (
  SELECT * FROM every_record
  UNION ALL SELECT * REPLACE (added + 1 AS added) FROM every_record WHERE id % 100 = 0
), record AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY released, rating NULLS LAST, added,
      content_rating_id NULLS LAST, content_rating NULLS LAST) AS rn FROM bronze
  ) WHERE rn = 1
), s_fact_items AS (
  SELECT id AS item_id, {_clean('name')} AS item_name, TRY_CAST(released AS DATE) AS released, tba,
    rating, ratings_count, reviews_text_count, reviews_count, added, playtime AS usage_hrs,
    status_o AS added_yet, status_f AS added_owned, flag_a AS added_beaten, flag_n AS added_toplay,
    flag_r AS added_dropped, no_discount AS added_playing, content_rating_id
  FROM record
), s_dim_content_ratings AS (
  SELECT DISTINCT content_rating_id, content_rating FROM record WHERE content_rating_id IS NOT NULL
), categories AS (
  SELECT DISTINCT l_orderkey AS item_id, CAST(regexp_extract(p_brand, '\\d+') AS BIGINT) AS category_id,
    CASE WHEN p_brand = 'Brand#25' THEN 'n/a' ELSE p_brand END AS category_name FROM lines
), platforms AS (
  SELECT DISTINCT l_orderkey AS item_id, CAST(n_nationkey AS BIGINT) AS platform_id,
    n_name AS platform_name FROM lines
), families AS (
  SELECT DISTINCT l_orderkey AS item_id, CAST(r_regionkey AS BIGINT) AS platform_family_id,
    r_name AS platform_family_name FROM lines
), stores AS (
  SELECT DISTINCT l_orderkey AS item_id, s_suppkey AS store_id, s_name AS store_name FROM lines
), tags AS (
  SELECT DISTINCT l_orderkey AS item_id, l_partkey AS tag_id, p_name AS tag_name,
    CASE WHEN p_size % 3 = 0 THEN 'rus' ELSE 'eng' END AS tag_language FROM lines
), s_dim_categories AS (
  SELECT DISTINCT category_id, category_name FROM categories WHERE category_id IS NOT NULL),
s_dim_platforms AS (SELECT DISTINCT platform_id, platform_name FROM platforms),
s_dim_platform_families AS (
  SELECT DISTINCT platform_family_id, platform_family_name FROM families),
s_dim_stores AS (SELECT DISTINCT store_id, store_name FROM stores),
s_dim_tags AS (SELECT DISTINCT tag_id, tag_name, tag_language FROM tags),
s_bridge_item_categories AS (SELECT item_id, category_id FROM categories WHERE category_id IS NOT NULL),
s_bridge_item_platforms AS (SELECT item_id, platform_id FROM platforms),
s_bridge_item_platform_families AS (SELECT item_id, platform_family_id FROM families),
s_bridge_item_stores AS (SELECT item_id, store_id FROM stores),
s_bridge_item_tags AS (SELECT item_id, tag_id FROM tags),
s_bridge_item_votes AS (
  SELECT id AS item_id, vote_id, vote_title, vote_count,
    100.0::DOUBLE * vote_count / n AS vote_percent
  FROM (
    SELECT id, n, 1::BIGINT AS vote_id, 'A' AS vote_title, flag_a AS vote_count FROM record
    UNION ALL SELECT id, n, 2, 'N', flag_n FROM record
    UNION ALL SELECT id, n, 3, 'R', flag_r FROM record
  ) WHERE vote_count > 0
), g_fact_items AS (
  SELECT f.* REPLACE ({_clean('f.item_name')} AS item_name),
    {_clean('d.content_rating')} AS content_rating,
    CAST(year(released) AS INTEGER) AS release_year,
    CAST(month(released) AS INTEGER) AS release_month
  FROM s_fact_items f LEFT JOIN s_dim_content_ratings d USING (content_rating_id)
), g_bridge_categories AS (
  SELECT category_id, item_id, {_clean('category_name')} AS category_name
  FROM s_bridge_item_categories LEFT JOIN s_dim_categories USING (category_id)
), g_bridge_platforms AS (
  SELECT platform_id, item_id, {_clean('platform_name')} AS platform_name
  FROM s_bridge_item_platforms LEFT JOIN s_dim_platforms USING (platform_id)
), g_bridge_platform_families AS (
  SELECT platform_family_id, item_id, {_clean('platform_family_name')} AS platform_family_name
  FROM s_bridge_item_platform_families LEFT JOIN s_dim_platform_families USING (platform_family_id)
), g_bridge_stores AS (
  SELECT store_id, item_id, {_clean('store_name')} AS store_name
  FROM s_bridge_item_stores LEFT JOIN s_dim_stores USING (store_id)
), g_bridge_votes AS (
  SELECT * REPLACE ({_clean('vote_title')} AS vote_title) FROM s_bridge_item_votes
), g_agg_top_tags AS (
  SELECT tag_id, {_clean('tag_name')} AS tag_name, count(item_id) AS item_count
  FROM s_bridge_item_tags JOIN s_dim_tags USING (tag_id) WHERE tag_language = 'eng'
  GROUP BY tag_id, s_dim_tags.tag_name ORDER BY item_count DESC, tag_id, s_dim_tags.tag_name LIMIT 100
)
"""

SILVER = ("fact_items", "dim_content_ratings", "dim_categories", "dim_platforms",
          "dim_platform_families", "dim_stores", "dim_tags", "bridge_item_categories",
          "bridge_item_platforms", "bridge_item_platform_families", "bridge_item_stores",
          "bridge_item_tags", "bridge_item_votes")
KEYS = {
    "dim_content_ratings": "content_rating_id", "dim_categories": "category_id",
    "dim_platforms": "platform_id", "dim_platform_families": "platform_family_id",
    "dim_stores": "store_id", "dim_tags": "tag_id",
}
GOLD = ("fact_items", "bridge_categories", "bridge_platforms", "bridge_platform_families",
        "bridge_stores", "bridge_votes", "agg_top_tags")
SCALARS = ("id, name, released, tba, rating, ratings_count, reviews_text_count, reviews_count, "
           "added, playtime")


# Filters of each dataset, and the selections of FIXTURES.md, as literals: not from the code under test.
EVERY = ("category", "family", "content_rating", "date_from", "date_to")
ACCEPTS = {
    "opt_categories": (), "opt_families": (), "opt_content_ratings": (),
    "kpi": EVERY,
    "category_stats": ("family", "content_rating", "date_from", "date_to"),
    "family_stats": ("category", "content_rating", "date_from", "date_to"),
    "release_trend": EVERY,
    "content_rating_dist": ("category", "family", "date_from", "date_to"),
    "vote_breakdown": EVERY, "top_tags": EVERY, "store_dist": EVERY, "top_items": EVERY,
    "rating_vs_usage": ("date_from", "date_to"), "category_by_family": ("date_from", "date_to"),
}
ALL_FIVE = {"category": "Brand#4", "family": "ASIA", "content_rating": "Not Rated",
            "date_from": "1996-01-01", "date_to": "1999-12-31"}
DATES_ONLY = {"date_from": "1996-01-01", "date_to": "1999-12-31"}
SELECTIONS = {
    "filter_category": {"category": "Brand#4"},
    "filter_family": {"family": "ASIA"},
    "filter_content_rating": {"content_rating": "Not Rated"},
    "filter_date_from": {"date_from": "1996-01-01"},
    "filter_date_to": {"date_to": "1999-12-31"},
    "filter_all": ALL_FIVE,
}
FEED_COLUMNS = {
    "category_options": ("opt_categories", "category_name"),
    "family_options": ("opt_families", "platform_family_name"),
    "content_rating_options": ("opt_content_ratings", "content_rating"),
    "total_items": ("kpi", "total_items"),
    "avg_rating": ("kpi", "avg_rating"),
    "median_usage": ("kpi", "median_usage_hrs"),
    "avg_ratings_count": ("kpi", "avg_ratings_count"),
    "categories_by_count": ("category_stats", "category_name,item_count"),
    "families_by_count": ("family_stats", "platform_family_name,item_count"),
    "category_groups_by_family": (
        "category_by_family", "platform_family_name,item_count,category_group"),
    "rating_against_usage": ("rating_vs_usage", "avg_usage_hrs,avg_rating,category_name"),
    "releases_per_year": ("release_trend", "release_year,item_count"),
    "content_rating_share": ("content_rating_dist", "content_rating,item_count"),
    "votes_by_title": ("vote_breakdown", "vote_title,total_votes"),
    "tags_by_count": ("top_tags", "tag_name,item_count"),
    "stores_by_count": ("store_dist", "store_name,item_count"),
    "rating_by_category": ("category_stats", "category_name,avg_rating"),
    "rating_by_family": ("family_stats", "platform_family_name,avg_rating"),
    "top_items_table": (
        "top_items", "item_name,released,rating,ratings_count,usage_hrs,content_rating"),
}

# What an item belongs to, as lists: one row per fact row, so membership needs no join per filter.
BASE += """, item AS (
  SELECT facts.*, categories, families, stores, tags, votes
  FROM g_fact_items AS facts
  LEFT JOIN (SELECT item_id, list(category_name) FILTER (category_name IS NOT NULL) AS categories
    FROM g_bridge_categories GROUP BY item_id) USING (item_id)
  LEFT JOIN (SELECT item_id, list(platform_family_name)
      FILTER (platform_family_name IS NOT NULL) AS families
    FROM g_bridge_platform_families GROUP BY item_id) USING (item_id)
  LEFT JOIN (SELECT item_id, list(store_name) FILTER (store_name IS NOT NULL) AS stores
    FROM g_bridge_stores GROUP BY item_id) USING (item_id)
  LEFT JOIN (SELECT item_id, list(tag_name) FILTER (tag_name IS NOT NULL) AS tags
    FROM tags WHERE tag_language = 'eng' GROUP BY item_id) USING (item_id)
  LEFT JOIN (SELECT item_id, list({title: vote_title, n: vote_count})
      FILTER (vote_title IS NOT NULL) AS votes
    FROM g_bridge_votes GROUP BY item_id) USING (item_id)
), largest AS (
  SELECT category_name AS big FROM g_bridge_categories GROUP BY category_name
  QUALIFY row_number() OVER (ORDER BY count(DISTINCT item_id) DESC, category_name NULLS FIRST) <= 5
)
"""


def _swap(sql: str, *changes: tuple[str, str]) -> str:
    for old, new in changes:
        assert sql.count(old) == 1, old
        sql = sql.replace(old, new)
    return sql


# The odd records of FIXTURES.md section 2.1.
ODD_BASE = _swap(
    BASE,
    (_RELEASED, _RELEASED.replace("CASE ", "CASE WHEN o_orderkey % 53 = 0 THEN '2020-13-45' ", 1)),
    ("THEN substr(o_orderpriority, 3) END",
     "THEN substr(o_orderpriority, 3) || CASE WHEN o_orderkey % 71 = 0 THEN ' (alt)' ELSE '' END END"),
    ("), categories AS (", "), plain_categories AS ("),
    ("), platforms AS (", """), categories AS (
  SELECT item_id, CASE WHEN item_id % 67 <> 0 OR category_name <> 'Brand#7' THEN category_id END AS category_id,
    category_name || CASE WHEN item_id % 59 = 0 THEN ' (alt)' ELSE '' END AS category_name
  FROM plain_categories, range(2) AS copies(copy) WHERE copy = 0 OR item_id % 61 = 0
), platforms AS ("""))
ODD_SILVER = ("fact_items", "dim_categories", "dim_content_ratings", "bridge_item_categories")
ODD_GOLD = ("fact_items", "bridge_categories")
ODD_DATASETS = ("kpi", "category_stats", "content_rating_dist", "category_by_family", "top_tags")

_TESTS = {
    "category": "list_contains(categories, '{}')",
    "family": "list_contains(families, '{}')",
    "content_rating": "ifnull(content_rating, 'Not Rated') = '{}'",
    "date_from": "released >= DATE '{}'",
    "date_to": "released <= DATE '{}'",
}


def _picked(given: dict, accepted=EVERY) -> str:
    """The rows of ``item`` that pass what is given and accepted, as a table expression."""
    tests = [_TESTS[name].format(given[name]) for name in accepted if given.get(name) is not None]
    return f"(SELECT * FROM item{' WHERE ' + ' AND '.join(tests) if tests else ''})"


def _mean(value: str, digits: int) -> str:
    return _round(f"sum({value}) / count({value})", digits)


def _placed(inner: str, order: str, size: int) -> str:
    columns = f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place"
    return f"{columns} FROM ({inner})) WHERE place <= {size}"


# Dataset -> SQL with a place for the items that pass the filters.
DATASET_SQL = {
    "opt_categories": "SELECT DISTINCT unnest(categories) AS category_name FROM {items}",
    "opt_families": "SELECT DISTINCT unnest(families) AS platform_family_name FROM {items}",
    "opt_content_ratings": """SELECT ifnull(content_rating, 'Not Rated') AS content_rating
      FROM {items} GROUP BY ALL""",
    "kpi": f"""SELECT count(*) AS total_items, {_mean('rating', 2)} AS avg_rating,
      CAST(min(usage_hrs) FILTER (share >= 0.5) AS DOUBLE) AS median_usage_hrs,
      {_mean('ratings_count', 0)} AS avg_ratings_count
      FROM (SELECT *, cume_dist() OVER (ORDER BY usage_hrs) AS share
        FROM {{items}} WHERE released IS NOT NULL)""",
    "category_stats": _placed(f"""SELECT category_name, count(DISTINCT item_id) AS item_count,
      {_mean('rating', 2)} AS avg_rating, {_mean('usage_hrs', 1)} AS avg_usage_hrs
      FROM (SELECT unnest(categories) AS category_name, item_id, rating, usage_hrs FROM {{items}})
      GROUP BY category_name""", "item_count DESC, category_name", 15),
    "family_stats": f"""SELECT platform_family_name, count(DISTINCT item_id) AS item_count,
      {_mean('rating', 2)} AS avg_rating
      FROM (SELECT unnest(families) AS platform_family_name, item_id, rating FROM {{items}})
      GROUP BY platform_family_name""",
    "release_trend": f"""SELECT release_year, count(DISTINCT item_id) AS item_count,
      {_mean('rating', 2)} AS avg_rating FROM {{items}}
      GROUP BY release_year HAVING release_year >= 1990 AND release_year <= year(today())""",
    "content_rating_dist": """SELECT ifnull(stored, 'Not Rated') AS content_rating, item_count
      FROM (SELECT content_rating AS stored, count(DISTINCT item_id) AS item_count
        FROM {items} GROUP BY stored)""",
    "vote_breakdown": """SELECT vote.title AS vote_title, CAST(sum(vote.n) AS BIGINT) AS total_votes
      FROM (SELECT unnest(votes) AS vote FROM {items}) GROUP BY ALL""",
    "top_tags": _placed("""SELECT tag_name, count(DISTINCT item_id) AS item_count
      FROM (SELECT item_id, unnest(tags) AS tag_name FROM {items}) GROUP BY tag_name""",
                        "item_count DESC, tag_name", 10),
    "store_dist": """SELECT store_name, count(DISTINCT item_id) AS item_count
      FROM (SELECT item_id, unnest(stores) AS store_name FROM {items}) GROUP BY store_name""",
    "top_items": f"""SELECT item_name, CAST(day AS VARCHAR) AS released,
        {_round('stars', 2)} AS rating, ratings_count, usage_hrs,
        ifnull(label, 'Not Rated') AS content_rating
      FROM (SELECT DISTINCT item_name, released AS day, rating AS stars, ratings_count, usage_hrs,
          content_rating AS label FROM {{items}} WHERE rating IS NOT NULL AND ratings_count >= 10)
      QUALIFY row_number() OVER (ORDER BY stars DESC, ratings_count DESC, item_name NULLS FIRST,
        day NULLS FIRST, usage_hrs NULLS FIRST, label NULLS FIRST) <= 20""",
    "rating_vs_usage": f"""SELECT category_name, {_mean('rating', 2)} AS avg_rating,
      {_mean('usage_hrs', 1)} AS avg_usage_hrs, count(DISTINCT item_id) AS item_count
      FROM (SELECT unnest(categories) AS category_name, item_id, rating, usage_hrs FROM {{items}}
        WHERE usage_hrs > 0 AND rating IS NOT NULL) GROUP BY category_name""",
    "category_by_family": """SELECT platform_family_name, ifnull(big, 'Other') AS category_group,
      count(DISTINCT item_id) AS item_count
      FROM (SELECT item_id, family AS platform_family_name, unnest(categories) AS name
        FROM (SELECT item_id, categories, unnest(families) AS family FROM {items}))
      LEFT JOIN largest ON name = big GROUP BY ALL""",
}


def dataset_sql(name: str, given: dict | None = None) -> str:
    return DATASET_SQL[name].replace("{items}", _picked(given or {}, ACCEPTS[name]))


DATASET_COLUMNS = {
    "kpi": ("total_items", "avg_rating", "median_usage_hrs", "avg_ratings_count"),
    "category_stats": ("category_name", "item_count", "avg_rating", "avg_usage_hrs"),
    "family_stats": ("platform_family_name", "item_count", "avg_rating"),
    "release_trend": ("release_year", "item_count", "avg_rating"),
    "content_rating_dist": ("content_rating", "item_count"),
    "vote_breakdown": ("vote_title", "total_votes"),
    "top_tags": ("tag_name", "item_count"),
    "store_dist": ("store_name", "item_count"),
    "top_items": ("item_name", "released", "rating", "ratings_count", "usage_hrs", "content_rating"),
    "rating_vs_usage": ("category_name", "avg_rating", "avg_usage_hrs", "item_count"),
    "category_by_family": ("platform_family_name", "category_group", "item_count"),
}


def _as_text(name: str, given: dict) -> str:
    columns = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in DATASET_COLUMNS[name])
    return f"SELECT '{name}' AS dataset, concat_ws('|', {columns}) AS content FROM ({dataset_sql(name, given)})"


def _listed(source: str, text: str) -> str:
    return f"(SELECT item_id, string_agg({text}, ';' ORDER BY {text}) AS v FROM {source} GROUP BY item_id)"


_BRONZE_CONTENT = f"""SELECT b.id, b.name, b.released, b.tba, b.rating, b.ratings_count, b.reviews_text_count,
  b.reviews_count, b.added, b.playtime,
  CASE WHEN b.n IS NOT NULL THEN c.v WHEN b.id % 2 = 0 THEN '' END AS categories,
  CASE WHEN b.n IS NOT NULL THEN p.v WHEN b.id % 2 = 0 THEN '' END AS platforms,
  CASE WHEN b.n IS NOT NULL THEN f.v WHEN b.id % 2 = 0 THEN '' END AS families,
  CASE WHEN b.n IS NOT NULL THEN s.v WHEN b.id % 2 = 0 THEN '' END AS stores,
  CASE WHEN b.n IS NOT NULL THEN t.v WHEN b.id % 2 = 0 THEN '' END AS tags,
  CASE WHEN b.n IS NOT NULL THEN v.v WHEN b.id % 2 = 0 THEN '' END AS votes,
  status_o AS yet, status_f AS owned, flag_a AS beaten, flag_n AS toplay, flag_r AS dropped, no_discount AS playing,
  content_rating_id, content_rating, TRUE AS no_media
FROM bronze b
LEFT JOIN {_listed("categories", "category_id || ':' || category_name")} c ON c.item_id = b.id
LEFT JOIN {_listed("platforms", "platform_id || ':' || platform_name")} p ON p.item_id = b.id
LEFT JOIN {_listed("families", "platform_family_id || ':' || platform_family_name")} f ON f.item_id = b.id
LEFT JOIN {_listed("stores", "store_id || ':' || store_name")} s ON s.item_id = b.id
LEFT JOIN {_listed("tags", "tag_id || ':' || tag_name || ':' || tag_language")} t ON t.item_id = b.id
LEFT JOIN {_listed("s_bridge_item_votes", "vote_id || ':' || vote_title || ':' || vote_count")} v ON v.item_id = b.id"""
_GATES = " UNION ALL ".join(
    f"SELECT '{case}' AS input, '{raised}' AS raised, (SELECT count(*) FROM bronze) AS rows_left"
    for case, raised in (
        ("no_rows", "NoRecords"), ("no_pages", "NoRecords"), ("missing_path", "AnalysisException"),
        ("missing_pages", "AnalysisException"), ("absent_column", "SchemaMismatch"), ("too_few_pages", "PagesMissing")))
_VARIANTS = lambda: _row_counts(
    {dim: _variants(dim, key) for dim, key in KEYS.items()}, "dimension", "keys_with_variants")


def _report() -> str:
    return f"""
          SELECT 'total_rows' AS "check", count(*) AS found FROM bronze
          UNION ALL SELECT 'distinct_keys', count(*) FROM record
          UNION ALL SELECT 'removed_rows', (SELECT count(*) FROM bronze) - (SELECT count(*) FROM record)
          UNION ALL SELECT 'date_rejects', count(*) FROM bronze
            WHERE {_clean('released')} IS NOT NULL AND TRY_CAST(released AS DATE) IS NULL
          UNION ALL """ + _row_counts(
        {f"{dim}_variants": _variants(dim, key) for dim, key in KEYS.items()}, '"check"', "found")


def _row_counts(parts: dict[str, str], label: str, count: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS {count} FROM ({sql})" for name, sql in parts.items())


def _variants(dim: str, key: str) -> str:
    return f"SELECT {key} FROM s_{dim} GROUP BY {key} HAVING count(*) > 1"


def oracle_sql() -> dict[str, str]:
    filtered = [name for name, accepted in ACCEPTS.items() if accepted]
    sql = {
        "page_flatten": f"SELECT {SCALARS}, n IS NOT NULL OR id % 2 = 0 AS has_genres FROM bronze",
        "json_round_trip": """
          SELECT b.id, b.added, n_categories, n_platforms, n_families, n_stores, n_tags,
            b.status_o AS yet, b.status_f AS owned, b.flag_a AS beaten, b.flag_n AS toplay,
            b.flag_r AS dropped, b.no_discount AS playing, b.content_rating_id,
            vote_id, vote_title, vote_count, vote_percent
          FROM bronze b JOIN s_bridge_item_votes v ON b.id = v.item_id
          JOIN (SELECT l_orderkey, CAST(count(DISTINCT p_brand) AS INTEGER) AS n_categories,
              CAST(count(DISTINCT n_nationkey) AS INTEGER) AS n_platforms,
              CAST(count(DISTINCT r_regionkey) AS INTEGER) AS n_families,
              CAST(count(DISTINCT s_suppkey) AS INTEGER) AS n_stores,
              CAST(count(DISTINCT l_partkey) AS INTEGER) AS n_tags
            FROM lines GROUP BY l_orderkey) ON l_orderkey = b.id""",
        "parquet_bronze_scan": f"SELECT {SCALARS} FROM bronze",
        "bronze_table_load": "SELECT id, name, released, rating, added, playtime FROM bronze",
        "null_tokens": f"""SELECT id, {_clean('name')} AS name, {_clean('released')} AS released, added
          FROM bronze""",
        "date_rejects": """SELECT count(*) AS date_rejects FROM bronze
          WHERE released IS NOT NULL AND TRY_CAST(released AS DATE) IS NULL""",
        "dim_key_violations": _VARIANTS(),
        "quality_report": _report(),
        **{f"silver_{name}": f"SELECT * FROM s_{name}" for name in SILVER},
        "silver_write_all": _row_counts(
            {name: f"SELECT * FROM s_{name}" for name in SILVER}, "table_name", "row_count"),
        **{f"gold_{name}": f"SELECT * FROM g_{name}" for name in GOLD},
        "gold_write_all": _row_counts(
            {name: f"SELECT * FROM g_{name}" for name in GOLD}, "table_name", "row_count"),
        **{name: "SELECT item_id, item_name, released, rating, usage_hrs, content_rating "
                 f"FROM {_picked(given)}" for name, given in SELECTIONS.items()},
        **{name: dataset_sql(name) for name in ACCEPTS},
        **{f"{name}_filtered": dataset_sql(name, ALL_FIVE) for name in filtered},
        "apply_to_all": _row_counts(
            {name: dataset_sql(name, ALL_FIVE) for name in filtered}, "dataset", "row_count"),
        "apply_to_all_content": " UNION ALL ".join(_as_text(name, ALL_FIVE) for name in filtered),
        "apply_together_filtered": " UNION ALL ".join(_as_text(name, ALL_FIVE) for name in filtered),
        "apply_together_dates": " UNION ALL ".join(_as_text(name, DATES_ONLY) for name in filtered),
        "bronze_content": _BRONZE_CONTENT,
        "gates": _GATES,
        "rejected_pages": """
          SELECT id, name, rating, NULL AS rejected_page FROM bronze
          UNION ALL SELECT NULL, NULL, NULL, '{"results":[{"id":' || id || ',"name":'
          FROM bronze WHERE id % 1000 = 0""",
        **{f"feed_{name}": f"SELECT {columns} FROM ({dataset_sql(dataset)})"
           for name, (dataset, columns) in FEED_COLUMNS.items()},
        "feed_all": " UNION ALL ".join(
            f"SELECT '{name}' AS feed, '{columns}' AS columns, count(*) AS row_count "
            f"FROM ({dataset_sql(dataset)})" for name, (dataset, columns) in FEED_COLUMNS.items()),
        "medallion_end_to_end": dataset_sql("kpi"),
    }
    odd = {
        **{f"odd_silver_{name}": f"SELECT * FROM s_{name}" for name in ODD_SILVER},
        **{f"odd_gold_{name}": f"SELECT * FROM g_{name}" for name in ODD_GOLD},
        **{f"odd_{name}": dataset_sql(name) for name in ODD_DATASETS},
        "odd_dim_key_violations": _VARIANTS(),
        "odd_quality_report": _report(),
    }
    sql = {name: f"{BASE} {body}" for name, body in sql.items()}
    sql |= {name: f"{ODD_BASE} {body}" for name, body in odd.items()}
    sql["dedupe_by_key"] = """
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
          l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
          l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST,
          l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS rn
        FROM lineitem) WHERE rn = 1"""
    sql["dedupe_report"] = """
      SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
        CAST(sum(n) - count(*) AS BIGINT) AS removed_rows
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
    sql["props_json_parse"] = """
      SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events"""
    return sql
