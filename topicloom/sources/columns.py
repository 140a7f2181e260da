"""Appending a computed column to a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_name(column: str, **params) -> str:
    """``<column>_<value><key>...`` in the order the parameters are given."""
    return column + "".join(f"_{value}{key}" for key, value in params.items())


def append_column(
    table: DataFrame,
    values: DataFrame,
    column: str,
    id_col: str = "id",
    na_value=None,
    **params,
) -> DataFrame:
    """``table`` with ``column`` of ``values`` added by id under its parameter name.

    Ids that ``values`` lacks get null, or ``na_value`` if one is given.  An id that has
    several values gets the largest.
    """
    name = column_name(column, **params)
    added = values.groupBy(F.col("id").alias(id_col)).agg(F.max(column).alias(name))
    out = table.drop(name).join(added, id_col, "left")
    return out if na_value is None else out.withColumn(name, F.coalesce(name, F.lit(na_value)))


def save_column(
    table: DataFrame, values: DataFrame, column: str, path: str, id_col: str = "id", na_value=None, **params
) -> None:
    """Write the table with the added column to a new path.

    A table cannot be overwritten while it is read, so the caller names a new version.
    """
    if column not in values.columns:
        raise ValueError(f"column {column!r} has not been computed yet")
    append_column(table, values, column, id_col, na_value, **params).write.parquet(path)
