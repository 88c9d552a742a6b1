"""Addressing columns by name and testing their cells."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.plans.policy import Condition

INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def named(name: str) -> Column:
    """The top-level column of that exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, or a longer one, that no column of the tables has."""
    taken = {column.lower() for table in tables for column in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def require_columns(df: DataFrame, names: Iterable[str], table: str = "table") -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} has no columns {missing}; it has {df.columns}")


def _equals(df: DataFrame, condition: Condition) -> Column:
    """Cell text equals the value, in a form the scan can push down.

    A cast on the column side would keep the test out of the Parquet reader, so
    integer columns are compared as integers. That is the same test: an integer
    prints in one way only, and a value written otherwise equals no cell.
    """
    kind = df.schema[condition.column].dataType
    cell = named(condition.column)
    bits = INTEGER_BITS.get(type(kind))
    if bits is None:
        return cell.cast("string") == F.lit(condition.value)
    if re.fullmatch(r"0|-?[1-9][0-9]*", condition.value):
        number = int(condition.value)
        if -(1 << bits - 1) <= number < 1 << bits - 1:
            return cell == F.lit(number).cast(kind)
    return F.lit(False)


def matches(df: DataFrame, conditions: Iterable[Condition]) -> Column:
    """All conditions hold (true for none); NULL cells make it NULL or false."""
    return reduce(and_, [_equals(df, c) for c in conditions], F.lit(True))
