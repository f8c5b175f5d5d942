"""Projection, filter, union and rename helpers."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FilterError(ValueError):
    """A condition no reader may ask for."""


def _one_of(column: Column, values: Any) -> Column:
    if isinstance(values, (str, bytes, Mapping)) or not isinstance(values, Collection):
        raise FilterError(f"a collection of values is needed, not {values!r}")
    return column.isin(*values) if values else F.lit(False)


#: Conditions a reader may ask for, each as the column it builds.
CONDITIONS: dict[str, Callable[[Column, Any], Column]] = {"=": lambda column, value: column == F.lit(value), "in": _one_of}


def condition(name: str, test: str, value: Any) -> Column:
    build = CONDITIONS.get(test.strip().lower())
    if build is None:
        raise FilterError(f"{name} {test}: choose one of {', '.join(CONDITIONS)}")
    return build(F.col(name), value)


def matching(df: DataFrame, conditions: Iterable[tuple[str, str, Any]] | None) -> DataFrame:
    """Rows that meet every (column, test, value); no value is in an empty collection."""
    wanted = []
    for item in conditions or ():
        if len(item) != 3:
            raise FilterError(f"(column, test, value) is needed, not {item!r}")
        wanted.append(condition(*item))
    return df.where(reduce(and_, wanted)) if wanted else df


def only(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The named columns, all of them for None; naming none at all is a mistake."""
    if columns is not None and not len(columns):
        raise ValueError("name a column, or pass None for all of them")
    return df if columns is None else df.select(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: missing ones NULL, extra ones dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def metrics_to_rows(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per (input row, metric) from a single scan."""
    return df.unpivot([F.col(i) for i in ids], [F.col(m) for m in metrics], name, value)


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Values any engine prints alike: dates, times and decimals as text, doubles rounded."""

    def view(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(column.cast("double"), digits).alias(field.name)
        return column

    return df.select(*[view(f) for f in df.schema.fields])
