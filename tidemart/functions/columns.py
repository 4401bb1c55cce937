"""Helpers for tables whose columns are optional."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names under which review text and product ids may arrive, by preference.
TEXT_COLUMNS = ("review_text", "comment", "content", "text")
PRODUCT_ID_COLUMNS = ("product_id", "item_id", "itemid")


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def text_column(df: DataFrame, name: str | None = None) -> str:
    """The column holding review text; raises when the table has none."""
    found = name or first_present(df, TEXT_COLUMNS)
    if found is None:
        raise ValueError(f"no review text column among {df.columns}")
    return found


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of `names` the table has, in the order asked for."""
    return [n for n in names if n in df.columns]


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Text becomes a timestamp, null where it cannot be read; timestamps pass unchanged."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def sortable(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns that have an order (maps and variants have none)."""
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields
        if f.name not in skip and not _unordered(f.dataType)
    ]


def _unordered(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _unordered(t.elementType)
    if isinstance(t, T.StructType):
        return any(_unordered(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType))
