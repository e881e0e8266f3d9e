"""Sources and sinks: landed pages, Parquet datasets, catalog tables."""

from starsmelt.sources.pages import (
    REJECTED,
    PagesMissing,
    TooManyRejects,
    encode_nested,
    land_pages,
    read_marked_pages,
    read_pages,
    require_pages,
)
from starsmelt.sources.parquet import (
    NoRecords,
    SchemaMismatch,
    read_parquet,
    require_columns,
    require_rows,
    write_parquet,
)
from starsmelt.sources.stage import Stage, shared_folder
from starsmelt.sources.tables import (
    Layer,
    LayerBusy,
    Layout,
    RowCountMismatch,
    TableMissing,
    Version,
    create_schema,
    load_table,
    read_table,
    row_count_check,
)

__all__ = [
    "Layer", "LayerBusy", "Layout", "NoRecords", "PagesMissing", "REJECTED", "RowCountMismatch",
    "SchemaMismatch", "Stage", "TableMissing", "TooManyRejects", "Version", "create_schema",
    "encode_nested", "land_pages", "load_table", "read_marked_pages", "read_pages", "read_parquet", "read_table",
    "require_columns", "require_pages", "require_rows", "row_count_check", "shared_folder", "write_parquet",
]
