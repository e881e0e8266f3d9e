"""JSON columns and the tables inside them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_json_columns(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Decode ``{source: (target, schema)}``; the text columns are dropped.

    Text that is not JSON gives NULL, a lone object where an array is expected gives one element,
    unknown members are dropped, and a member of the wrong type is NULL alone. Stage the result
    before exploding it: Spark repeats the decoding in every filter it infers from an explode.
    """
    kept = [F.col(name) for name in df.columns if name not in columns]
    decoded = [F.from_json(name, schema).alias(target) for name, (target, schema) in columns.items()]
    return df.select(*kept, *decoded)


def struct_dimension(
    df: DataFrame, struct_col: str, fields: Mapping[str, str], id_col: str
) -> DataFrame:
    """Distinct ``{output: path}`` of a struct column, where the id is known."""
    picked = df.select(*[F.col(f"{struct_col}.{path}").alias(out) for out, path in fields.items()])
    return picked.filter(F.col(id_col).isNotNull()).distinct()


def _exploded(df: DataFrame, array_col: str, fields: Mapping[str, str], *keep) -> DataFrame:
    elements = df.select(*keep, F.explode(array_col).alias("_element"))
    names = [name for name in elements.columns if name != "_element"]
    return elements.select(
        *names, *[F.col(f"_element.{path}").alias(out) for out, path in fields.items()]
    )


def explode_dimension(
    df: DataFrame, array_col: str, fields: Mapping[str, str], id_col: str
) -> DataFrame:
    """Distinct ``{output: path}`` over all elements of an array column, where the id is known.

    Distinct on all outputs: an id with two names gives two rows. Repeats collapse before the
    shuffle, so the popular values cost no more than the rare ones.
    """
    return _exploded(df, array_col, fields).filter(F.col(id_col).isNotNull()).distinct()


def explode_bridge(
    df: DataFrame,
    key: tuple[str, str],
    array_col: str,
    fields: Mapping[str, str],
    id_col: str,
) -> DataFrame:
    """One row per element of an array column with ``key`` (source, output), where the id is known.

    Repeated elements stay. With a single output the field itself is exploded, not the struct:
    Parquet then reads that one member of the nested column. No shuffle.
    """
    source, out_key = key
    if len(fields) == 1:
        ((out, path),) = fields.items()
        rows = df.select(
            F.col(source).alias(out_key), F.explode(F.col(f"{array_col}.{path}")).alias(out)
        )
    else:
        rows = _exploded(df, array_col, fields, F.col(source).alias(out_key))
    return rows.filter(F.col(id_col).isNotNull())
