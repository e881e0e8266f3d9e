"""Layers of tables: immutable versions, and one small file that says which are current.

A layer is a folder. A table is written to a fresh folder below it, which never changes or moves:

    layer/fact_items/1a2b3c4d/part-….parquet      a version of a table
    layer/_log/00000000000000000007.json          folder, columns and layout of every current table

A log entry appears whole, under a number that nothing had before, by renaming one small file. With it
all tables of a run become current at once: whoever reads the log sees the tables of one run, whenever
the writer stops. An entry is also the layout manifest: another application registers the versions it
names as external tables with their buckets, so its joins need no shuffle either.

In the catalog a version is an external table and the table's own name is a view on it. Views follow the
log, each replaced in one step; a writer that stopped between them leaves views on the version before,
which is kept, and :meth:`Layer.sync` finishes what it began.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from threading import Event

from pyspark.sql import DataFrame, SparkSession

from starsmelt.sources import folders
from starsmelt.sources.parquet import CODEC, require_columns, require_rows

#: Log entries whose versions stay readable: the current one, and the one before for running queries.
KEPT_ENTRIES = 2
_LOG = "_log"


class RowCountMismatch(ValueError):
    """A table does not hold the rows it was loaded from."""


class TableMissing(KeyError):
    """No run has written this table to its layer."""


class LayerBusy(RuntimeError):
    """Other writers took every log entry that this one tried to write."""


@dataclass(frozen=True)
class Layout:
    """How a table is laid out: hash buckets on ``key``, each file sorted on ``sort``.

    Tables bucketed alike on the join key join without a shuffle, and a distinct count per
    (group, key) needs none either. Sorting on the column that filters most gives row groups narrow
    ranges to skip by. ``buckets`` None writes a plain table.
    """

    key: str | None = None
    sort: tuple[str, ...] = ()
    buckets: int | None = None


@dataclass(frozen=True)
class Version:
    """One written state of a table: its name, run, columns as DDL, and layout."""

    table: str
    run: str
    columns: str
    layout: Layout

    @property
    def folder(self) -> str:
        return f"{self.table}/{self.run}"

    @classmethod
    def from_json(cls, found: dict) -> Version:
        layout = found["layout"]
        return cls(found["table"], found["run"], found["columns"],
                   Layout(layout["key"], tuple(layout["sort"]), layout["buckets"]))


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


class Layer:
    """The tables of one schema, kept in ``location/schema``, or in the schema's own folder.

    With a location the catalog holds names only: dropping its schema leaves the layer as it is.
    """

    def __init__(self, spark: SparkSession, schema: str, location: str | None = None):
        self.spark, self.schema = spark, schema
        self._root = f"{location}/{schema}" if location else None
        self._registered: set[str] = set()

    def create(self) -> None:
        create_schema(self.spark, self.schema)

    @property
    def root(self) -> str:
        return self._root or self.spark.catalog.getDatabase(self.schema).locationUri

    def _path(self, version: Version) -> str:
        return f"{self.root}/{version.folder}"

    def _alias(self, version: Version) -> str:
        return f"{self.schema}.{version.table}__{version.run}"

    # The log

    def entries(self) -> list[int]:
        found = folders.names(self.spark, f"{self.root}/{_LOG}")
        return sorted(int(name[:-5]) for name in found if name.endswith(".json") and name[:-5].isdigit())

    def _entry_path(self, number: int) -> str:
        return f"{self.root}/{_LOG}/{number:020d}.json"

    def entry(self, number: int) -> dict[str, Version]:
        found = json.loads(folders.read_text(self.spark, self._entry_path(number)))
        return {name: Version.from_json(version) for name, version in found.items()}

    def current(self) -> dict[str, Version]:
        """The tables of the last entry, all of one moment."""
        numbers = self.entries()
        return self.entry(numbers[-1]) if numbers else {}

    # Reading

    def frame(self, version: Version) -> DataFrame:
        """A scan of one version, with its buckets. The catalog is asked once for each version."""
        alias = self._alias(version)
        if alias not in self._registered:
            self._register(version)
            self._registered.add(alias)
        return self.spark.table(alias)

    def read(self, table: str, tables: Mapping[str, Version] | None = None) -> DataFrame:
        """A table as it is now, or as ``tables``, an earlier answer of :meth:`current`, has it."""
        tables = self.current() if tables is None else tables
        if table not in tables:
            raise TableMissing(f"no run has written {table} to {self.root}")
        return self.frame(tables[table])

    def _register(self, version: Version) -> None:
        if self.spark.catalog.tableExists(self._alias(version)):
            return
        self.create()
        layout, clause = version.layout, ""
        if layout.key and layout.buckets:
            ordered = f" SORTED BY ({', '.join(f'`{c}`' for c in layout.sort)})" if layout.sort else ""
            clause = f" CLUSTERED BY (`{layout.key}`){ordered} INTO {layout.buckets} BUCKETS"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._alias(version)} ({version.columns}) USING parquet"
                       f"{clause} LOCATION '{self._path(version)}'")

    # Writing

    def write(
        self,
        tables: Mapping[str, DataFrame],
        layouts: Mapping[str, Layout] | None = None,
        verify: Callable[[DataFrame], None] | None = None,
        at_once: int = 4,
    ) -> None:
        """Replace tables of the layer, all at one moment; the others stay.

        The tables are written ``at_once`` jobs at a time, since small ones leave most of a cluster
        idle; none is begun after a failure. ``verify`` gets each written table and rejects it by
        raising. A failure before the log entry leaves the layer as it was and nothing behind.
        """
        layouts, failed = layouts or {}, Event()
        self.create()

        def put(table: str) -> Version | None:
            if failed.is_set():
                return None
            try:
                return self._stage(table, tables[table], layouts.get(table, Layout()), verify)
            except BaseException:
                failed.set()
                raise

        with ThreadPoolExecutor(max_workers=at_once) as pool:
            jobs = {table: pool.submit(put, table) for table in tables}
        errors = [job.exception() for job in jobs.values() if job.exception()]
        fresh = {table: job.result() for table, job in jobs.items() if not job.exception() and job.result()}
        try:
            if errors:
                raise errors[0]
            self._commit(fresh)
        except BaseException:
            known = self.current()
            for table, version in fresh.items():
                if known.get(table) != version:
                    self._discard(version)
            raise
        self._swap_views(fresh)
        self._retire()

    def _stage(
        self, table: str, df: DataFrame, layout: Layout, verify: Callable[[DataFrame], None] | None
    ) -> Version:
        """Write ``df`` as a fresh version and verify it; a failure leaves nothing."""
        version = Version(table, uuid.uuid4().hex[:12], df.schema.toDDL(), layout)
        if layout.buckets and layout.key:
            writer = df.repartition(layout.buckets, layout.key).write.bucketBy(layout.buckets, layout.key)
            if layout.sort:
                writer = writer.sortBy(*layout.sort)
        else:
            writer = df.write
        try:
            (writer.format("parquet").option("compression", CODEC)
             .option("path", self._path(version)).saveAsTable(self._alias(version)))
            if verify:
                verify(self.spark.table(self._alias(version)))
        except BaseException:
            self._discard(version)
            raise
        return version

    def _discard(self, version: Version) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._alias(version)}")
        folders.remove(self.spark, self._path(version))

    def _commit(self, fresh: Mapping[str, Version], attempts: int = 20) -> None:
        """Add the log entry that makes ``fresh`` current, beside whatever others wrote meanwhile."""
        for _ in range(attempts):
            numbers = self.entries()
            tables = {**(self.entry(numbers[-1]) if numbers else {}), **fresh}
            text = json.dumps({name: asdict(version) for name, version in sorted(tables.items())}, indent=1)
            if folders.put_new(self.spark, self._entry_path(numbers[-1] + 1 if numbers else 0), text):
                return
        raise LayerBusy(f"other writers took {attempts} log entries of {self.root}")

    def _swap_views(self, tables: Mapping[str, Version]) -> None:
        for table, version in tables.items():
            self._swap_view(table, version)

    def _swap_view(self, table: str, version: Version) -> None:
        """Let the table's name mean this version: one step of the catalog."""
        self._register(version)
        name = f"{self.schema}.{table}"
        if self.spark.catalog.tableExists(name) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"ALTER TABLE {name} RENAME TO {name}__before_{version.run}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {self._alias(version)}")

    def sync(self) -> None:
        """Let all views follow the log, and drop what older entries still held."""
        current = self.current()
        if current:
            self.create()
            self._swap_views(current)
            self._retire()

    def _retire(self) -> None:
        """Delete versions that no kept entry names, then their entries. May be repeated at will."""
        numbers = self.entries()
        kept = {version for number in numbers[-KEPT_ENTRIES:] for version in self.entry(number).values()}
        for number in numbers[:-KEPT_ENTRIES]:
            for version in set(self.entry(number).values()) - kept:
                self._discard(version)
            folders.remove(self.spark, self._entry_path(number))

    def vacuum(self, older_than_s: float = 7 * 86400) -> list[str]:
        """Delete versions that no entry names and that writers which were killed left behind.

        Only folders unchanged for ``older_than_s`` go, since a running writer's are not named yet.
        """
        named = {version.folder for number in self.entries() for version in self.entry(number).values()}
        before = (time.time() - older_than_s) * 1000
        gone = []
        for table in folders.names(self.spark, self.root):
            if table.startswith("_"):
                continue
            for run, changed in folders.names(self.spark, f"{self.root}/{table}").items():
                if f"{table}/{run}" not in named and changed < before:
                    self._discard(Version(table, run, "", Layout()))
                    gone.append(f"{table}/{run}")
        return gone


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def row_count_check(df: DataFrame, expected: int) -> int:
    """Rows of a written table, which must be ``expected``. A Parquet count reads footers only."""
    found = df.count()
    if found != expected:
        raise RowCountMismatch(f"{found} rows were written, expected {expected}")
    return found


def load_table(layer: Layer, path: str, table: str, schema: str) -> int:
    """Replace a table with a staged Parquet dataset and verify the count.

    A missing path, a column that is absent or of another type in any file, a dataset without rows and
    a wrong count all raise and leave the old table as it was.
    """
    require_columns(layer.spark, path, schema)
    source = require_rows(layer.spark.read.schema(schema).parquet(path), path)
    rows = source.count()
    layer.write({table: source}, verify=lambda written: row_count_check(written, rows))
    return rows
