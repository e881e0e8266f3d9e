"""Parquet datasets by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: JSON text and nested columns are most of what is written, so the denser codec is worth its time.
CODEC = "zstd"


class NoRecords(ValueError):
    """An extract that must have records has none."""


class SchemaMismatch(ValueError):
    """A dataset lacks a column, or has it in another type."""


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Scan a dataset; with a schema, only its columns, which must be there. A missing path raises."""
    if schema is None:
        return spark.read.parquet(path)
    require_columns(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop when there is nothing to process. Reads at most one row."""
    if df.isEmpty():
        raise NoRecords(f"no records in {what}")
    return df


def require_columns(spark: SparkSession, path: str, schema: str) -> None:
    """Stop unless the dataset has every column of ``schema`` in its type.

    The footers of all files are read, in parallel: files that differ in a column's type raise, and a
    column counts as there if some file has it, as in a dataset that was appended to.
    """
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except Exception as failure:
        if "CANNOT_MERGE" not in str(failure):  # the class differs with the place that finds it
            raise
        raise SchemaMismatch(f"{path}: files differ in the type of a column") from failure
    kinds = {field.name: field.dataType for field in found}
    wrong = [field.name for field in StructType.fromDDL(schema) if kinds.get(field.name) != field.dataType]
    if wrong:
        raise SchemaMismatch(f"{path}: absent or of another type: {', '.join(wrong)}")
