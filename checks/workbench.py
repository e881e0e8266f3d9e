"""The layers built from one folder of star tables, each table written on first use.

Queries of one application share what they have in common, as the datasets of a deployment share
the written gold tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from starsmelt.fixtures import odd_records, records_from_star, to_bronze
from starsmelt.plans.gold import GOLD_TABLES, NAMED_BRIDGES, gold_layout, gold_table
from starsmelt.plans.medallion import MedallionTables, Target, run_medallion
from starsmelt.plans.silver import SILVER_TABLES, parsed_items, silver_layout, silver_table
from starsmelt.sources import Layer, Stage, Version, land_pages

# Silver tables each gold table is built from.
_NEEDS = {
    "fact_items": ("fact_items", "dim_content_ratings"),
    "bridge_votes": ("bridge_item_votes",),
    "agg_top_tags": ("bridge_item_tags", "dim_tags"),
    "index_item_tags": ("bridge_item_tags", "dim_tags"),
    "index_largest_categories": ("bridge_item_categories", "dim_categories"),
    **{name: (bridge, dim) for name, (bridge, dim, _, _) in NAMED_BRIDGES.items()},
}


class Workbench(Mapping):
    """``"silver.dim_tags"`` or ``"gold.fact_items"`` -> DataFrame over a written table."""

    def __init__(self, spark: SparkSession, folder: str, odd: bool = False):
        self.spark, self.folder, self.odd = spark, folder, odd
        self.stage = Stage(spark)
        self.target = self.new_target()
        self._layers = {name: self.target.layer(spark, name) for name in ("silver", "gold")}
        self._versions: dict[str, Version] = {}

    def new_target(self, **options) -> Target:
        run = f"smelt_{uuid.uuid4().hex[:8]}"
        target = Target(
            f"{run}_bronze", f"{run}_silver", f"{run}_gold", location=self.stage.folder,
            **{"rows_per_bucket": ROWS_PER_BUCKET, **options},
        )
        target.create(self.spark)
        return target

    @cached_property
    def records(self) -> DataFrame:
        """Staged, for a query that reads records in more than one form: it asks for them before the forms."""
        return self.stage.put(self.records_once, "typed")

    @property
    def records_once(self) -> DataFrame:
        """The records for one reading: as staged if some query has staged them, else made on the way."""
        if "records" in self.__dict__:
            return self.records
        records = records_from_star(self.spark, self.folder)
        return odd_records(records) if self.odd else records

    @cached_property
    def pages(self) -> str:
        path = self.stage.path("pages")
        land_pages(self.records_once, path)
        return path

    @cached_property
    def bronze(self) -> DataFrame:
        return self.stage.put(to_bronze(self.records_once), "bronze")

    @cached_property
    def parsed(self) -> DataFrame:
        return parsed_items(self.bronze, self.stage)

    @cached_property
    def buckets(self) -> int:
        return self.target.buckets_for(
            self.bronze.count(), self.spark.sparkContext.defaultParallelism)

    @cached_property
    def end_to_end(self) -> MedallionTables:
        return run_medallion(self.spark, self.pages, self.new_target())

    def build_silver(self, name: str) -> DataFrame:
        return silver_table(name, self.parsed)

    def build_gold(self, name: str) -> DataFrame:
        return gold_table(name, {need: self[f"silver.{need}"] for need in _NEEDS[name]})

    def __getitem__(self, name: str) -> DataFrame:
        layer, table = name.split(".")
        build, layout = {
            "silver": (self.build_silver, silver_layout), "gold": (self.build_gold, gold_layout),
        }[layer]
        owner: Layer = self._layers[layer]
        if name not in self._versions:
            owner.write({table: build(table)}, {table: layout(table, self.buckets)})
            self._versions[name] = owner.current()[table]
        return owner.frame(self._versions[name])

    def __iter__(self) -> Iterator[str]:
        yield from (f"silver.{name}" for name in SILVER_TABLES)
        yield from (f"gold.{name}" for name in GOLD_TABLES)

    def __len__(self) -> int:
        return len(SILVER_TABLES) + len(GOLD_TABLES)


#: Items of a bucket: a task of a dataset that joins all bridges keeps the lists of one bucket, some 3 KB an item.
ROWS_PER_BUCKET = 200_000

_WORKBENCHES: dict[tuple[str, str, bool], Workbench] = {}


def workbench(spark: SparkSession, folder: str, odd: bool = False) -> Workbench:
    """The tables of a folder, or of its odd records, for the life of the application.

    Whatever an earlier query has built is read, not built again, so the time of a query is not that
    of its whole build; ``bench.py`` times builds apart.
    """
    key = (spark.sparkContext.applicationId, str(folder), odd)
    if key not in _WORKBENCHES:
        _WORKBENCHES[key] = Workbench(spark, str(folder), odd)
    return _WORKBENCHES[key]
