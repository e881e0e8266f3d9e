"""Landed pages of source records: one JSON object per page, ``{"results": [record, ...]}``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starsmelt.schemas import BRONZE_FIELDS, ddl


#: Column of a page that is not JSON of the expected types, with the page's text.
REJECTED = "rejected_page"


class TooManyRejects(ValueError):
    """More pages were rejected than a load may skip."""


class PagesMissing(ValueError):
    """Fewer or more pages landed than the extract announced."""


def read_pages(
    spark: SparkSession,
    path: str,
    fields: dict[str, str] = BRONZE_FIELDS,
    pages_seen: Observation | None = None,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """One row per record of the landed pages; a page without ``results`` gives no rows.

    Fields typed ``string`` that are nested in the source keep their raw JSON text, which is the
    bronze form. One page per line is the default: plain files of this kind are splittable, so a page file
    of any size spreads over many tasks; a compressed one is read by one task. Set ``multi_line`` for pretty-printed pages, one per file. A page
    that is not JSON raises rather than vanishing. ``pages_seen`` receives ``pages``, the number of
    pages read, when the result is written; :func:`require_pages` checks it.
    """
    pages = (
        spark.read.schema(f"results array<struct<{ddl(fields)}>>")
        .option("multiLine", multi_line)
        .option("mode", mode)
        .json(path)
    )
    if pages_seen is not None:
        pages = pages.observe(pages_seen, F.count(F.lit(1)).alias("pages"))
    return pages.select(F.inline("results"))


def read_marked_pages(
    spark: SparkSession,
    path: str,
    fields: dict[str, str] = BRONZE_FIELDS,
    pages_seen: Observation | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Records of the good pages and the text of the bad ones, from one reading.

    A record has a NULL ``rejected_page``; a bad page is one row that has its text there and nothing
    else. A page is bad as a whole if it is not JSON or if any field has another type, so no record
    is taken from a page that was understood in part. ``pages_seen`` receives ``pages`` and
    ``bad_pages`` when the result is written.
    """
    pages = (
        spark.read.schema(f"results array<struct<{ddl(fields)}>>, {REJECTED} string")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .json(path)
    )
    if pages_seen is not None:
        pages = pages.observe(
            pages_seen, F.count(F.lit(1)).alias("pages"), F.count(REJECTED).alias("bad_pages"))
    bad = F.col(REJECTED).isNotNull()
    return pages.filter(bad | (F.size("results") > 0)).select(
        F.inline_outer(F.when(~bad, F.col("results"))), REJECTED)


def require_pages(pages_seen: Observation, expected: int | None, path: str) -> None:
    """Raise unless the pages read are those the extract announced; None expects nothing."""
    found = pages_seen.get["pages"]
    if expected is not None and found != expected:
        raise PagesMissing(f"expected {expected} pages in {path}, found {found}")


def encode_nested(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nested columns as JSON text, with null members written out; a NULL value stays NULL."""
    nested = set(columns)
    return df.select(*[
        F.to_json(name, {"ignoreNullFields": "false"}).alias(name) if name in nested else F.col(name)
        for name in df.columns
    ])


def _in_pages(page_size: int):
    """Records as JSON text, one row each -> pages as text, made of neighbours within a task."""
    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, page_size):
                records = batch.column(0).slice(start, page_size).to_pylist()
                yield pa.RecordBatch.from_pydict({"value": ['{"results":[' + ",".join(records) + "]}"]})
    return pages


def land_pages(df: DataFrame, path: str, page_size: int = 40, pages_per_file: int = 5_000) -> None:
    """Write records as page objects, one per line, at most ``page_size`` records in each.

    A page holds neighbours of one task, so nothing moves and no record is sorted or held beyond its
    Arrow batch. Pages are many times their compressed size. A gzip file is read by one task, so it is
    bounded: at most ``pages_per_file`` pages, whatever the data.
    """
    records = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    pages = records.mapInArrow(_in_pages(page_size), "value string")
    (pages.write.mode("overwrite").option("compression", "gzip")
     .option("maxRecordsPerFile", pages_per_file).text(path))
