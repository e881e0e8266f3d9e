"""Landed pages to gold in one Spark application."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starsmelt.operators.quality import (
    date_rejects,
    dedupe_report,
    dim_key_unique,
    null_tokens_to_null,
)
from starsmelt.plans.gold import GOLD_TABLES, build_gold, build_indexes, gold_layout
from starsmelt.plans.silver import DIMENSION_KEYS, SILVER_TABLES, build_silver, silver_layout
from starsmelt.schemas import BRONZE_FIELDS, BRONZE_SCHEMA
from starsmelt.sources.pages import REJECTED, TooManyRejects, read_marked_pages, read_pages, require_pages
from starsmelt.sources.parquet import NoRecords, require_rows
from starsmelt.sources.stage import Stage
from starsmelt.sources.tables import Layer, Version, load_table, row_count_check


LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Target:
    """Where the layers live: below ``location``, which another application can read without sharing
    the catalog, or else in the folders of the catalog's schemas.

    ``buckets`` None sizes the buckets by the row count of bronze: as many as keep a bucket within
    ``rows_per_bucket`` items, and on small data one per core while each has
    ``min_rows_per_bucket``. 0 writes plain tables. Buckets are layout only: rows do not depend on it.
    """

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    location: str | None = None
    buckets: int | None = None
    rows_per_bucket: int = 2_000_000
    min_rows_per_bucket: int = 20_000

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer)}.{name}"

    def layer(self, spark: SparkSession, layer: str) -> Layer:
        return Layer(spark, getattr(self, layer), self.location)

    def create(self, spark: SparkSession) -> None:
        """Make the schemas, and finish what a killed run began."""
        for name in LAYERS:
            layer = self.layer(spark, name)
            layer.create()
            layer.sync()

    def buckets_for(self, rows: int, cores: int) -> int:
        if self.buckets is not None:
            return self.buckets
        busy = min(cores, -(-rows // self.min_rows_per_bucket))
        return max(1, busy, -(-rows // self.rows_per_bucket))


class MedallionTables(Mapping):
    """The written tables as ``"layer.table"`` -> DataFrame, for the datasets.

    A layer's log is read once, at its first table, so all answers come from one run of that layer
    until :meth:`refresh`. The log in the target's folder decides: a catalog table of the same name that
    lies elsewhere is not read, and a table that no run has written raises. Iteration gives silver and
    gold; bronze can be read too.
    """

    def __init__(self, spark: SparkSession, target: Target = Target()):
        self.spark, self.target = spark, target
        self.refresh()

    def refresh(self) -> None:
        """See what has been written since."""
        self._layers: dict[str, Layer] = {}
        self._current: dict[str, dict[str, Version]] = {}

    def __getitem__(self, name: str) -> DataFrame:
        layer, table = name.split(".")
        if layer not in self._current:
            self._layers[layer] = self.target.layer(self.spark, layer)
            self._current[layer] = self._layers[layer].current()
        return self._layers[layer].read(table, self._current[layer])

    def __iter__(self) -> Iterator[str]:
        yield from (f"silver.{name}" for name in SILVER_TABLES)
        yield from (f"gold.{name}" for name in GOLD_TABLES)

    def __len__(self) -> int:
        return len(SILVER_TABLES) + len(GOLD_TABLES)


def load_bronze(
    spark: SparkSession,
    source: str,
    target: Target,
    source_format: str = "pages",
    expected_pages: int | None = None,
    max_bad_pages: int = 0,
) -> int:
    """Replace the bronze table and return its verified row count; an empty extract raises.

    A bad page raises, unless ``max_bad_pages`` allows some: up to so many are skipped and their texts
    become ``bronze.rejected_pages``, current at the same moment as the records. That table tells of
    the last load that allowed any.

    ``source`` holds landed pages or, with ``source_format`` ``"parquet"``, staged records. Pages go
    to the table in one pass: pages and rows are counted while they are written, and a wrong count
    raises before the old table is replaced.
    """
    layer = target.layer(spark, "bronze")
    if source_format == "parquet":
        rows = load_table(layer, source, "items", BRONZE_SCHEMA)
    elif max_bad_pages:
        rows = _load_good_pages(spark, source, layer, expected_pages, max_bad_pages)
    else:
        pages_seen, rows_seen = Observation(), Observation()
        records = read_pages(spark, source, BRONZE_FIELDS, pages_seen)

        def verify(written: DataFrame) -> None:
            require_pages(pages_seen, expected_pages, source)
            if row_count_check(written, rows_seen.get["rows"]) == 0:
                raise NoRecords(f"no records in {source}")

        counted = records.observe(rows_seen, F.count(F.lit(1)).alias("rows"))
        layer.write({"items": counted}, verify=verify)
        rows = rows_seen.get["rows"]
    return rows


def _load_good_pages(
    spark: SparkSession, source: str, layer: Layer, expected_pages: int | None, max_bad_pages: int
) -> int:
    """Records and rejects from one reading of the pages, which is staged: both tables scan that."""
    pages_seen = Observation()
    with Stage(spark) as stage:
        marked = stage.put(read_marked_pages(spark, source, BRONZE_FIELDS, pages_seen), "marked")
        require_pages(pages_seen, expected_pages, source)
        found = pages_seen.get["bad_pages"]
        if found > max_bad_pages:
            raise TooManyRejects(f"{found} bad pages in {source}, at most {max_bad_pages} may be skipped")
        records = require_rows(marked.filter(F.col(REJECTED).isNull()).drop(REJECTED), source)
        rejects = marked.filter(F.col(REJECTED).isNotNull()).select(REJECTED)
        rows = records.count()

        def verify(written: DataFrame) -> None:
            row_count_check(written, found if written.columns == [REJECTED] else rows)

        layer.write({"items": records, "rejected_pages": rejects}, verify=verify)
    return rows


def _write_layer(
    layer: Layer, built: Mapping[str, DataFrame], layout: Callable, buckets: int
) -> None:
    layer.write(built, {name: layout(name, buckets) for name in built})


def refine_silver(spark: SparkSession, target: Target, stage: Stage, buckets: int) -> None:
    built = build_silver(target.layer(spark, "bronze").read("items"), stage)
    _write_layer(target.layer(spark, "silver"), built, silver_layout, buckets)


def refine_gold(spark: SparkSession, target: Target, buckets: int) -> None:
    layer = target.layer(spark, "silver")
    tables = layer.current()  # all of one run
    silver = {name: layer.read(name, tables) for name in SILVER_TABLES}
    _write_layer(target.layer(spark, "gold"), {**build_gold(silver), **build_indexes(silver)}, gold_layout, buckets)


def quality_report(tables: MedallionTables) -> DataFrame:
    """What the cleaning met, as ``(check, found)``: duplicates, bad dates, ids with two names.

    Bronze is read for its key and date columns only.
    """
    bronze = null_tokens_to_null(
        tables["bronze.items"].select("id", "released"))
    counts = dedupe_report(bronze, ["id"]).unpivot(
        [], ["total_rows", "distinct_keys", "removed_rows"], "check", "found")
    rejects = date_rejects(bronze, "released").unpivot([], ["date_rejects"], "check", "found")
    report = counts.unionByName(rejects)
    for name, key in DIMENSION_KEYS.items():
        variants = dim_key_unique(tables[f"silver.{name}"], key)
        report = report.unionByName(
            variants.agg(F.count(F.lit(1)).alias("found"))
            .select(F.lit(f"{name}_variants").alias("check"), "found"))
    return report


def run_medallion(
    spark: SparkSession,
    source: str,
    target: Target = Target(),
    source_format: str = "pages",
    expected_pages: int | None = None,
    max_bad_pages: int = 0,
) -> MedallionTables:
    """All steps in order; the first that fails raises and the later ones do not start."""
    target.create(spark)
    rows = load_bronze(spark, source, target, source_format, expected_pages, max_bad_pages)
    buckets = target.buckets_for(rows, spark.sparkContext.defaultParallelism)
    with Stage(spark) as stage:
        refine_silver(spark, target, stage, buckets)
    refine_gold(spark, target, buckets)
    return MedallionTables(spark, target)
