"""Numeric treatments."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# From here on a double has no fraction.
WHOLE = float(1 << 53)


# The spellings of a number in text, decimal and hexadecimal.
DECIMAL = r"([0-9]++(\.[0-9]*+)?|\.[0-9]++)([eE][+-]?[0-9]++)?"
HEXADECIMAL = r"0[xX]([0-9a-fA-F]++\.?|[0-9a-fA-F]*+\.[0-9a-fA-F]++)[pP][+-]?[0-9]++"
NUMBER = rf"^[\x00-\x20]*+[+-]?(NaN|Infinity|({DECIMAL}|{HEXADECIMAL})[fFdD]?)[\x00-\x20]*+\z"


def has_numbers(kind: T.DataType) -> bool:
    """Whether cells of that type can be numbers."""
    return isinstance(kind, (T.NumericType, T.StringType))


def to_number(col: Column, kind: T.DataType) -> Column:
    """The cell as a double; NULL where its text is not a number.

    The pattern decides, not the cast: a failed cast costs far more than a
    failed match, and the cast also takes words such as ``nan`` and ``Inf``.
    """
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if not isinstance(kind, T.StringType):
        raise ValueError(f"a numeric treatment needs numbers or text, not {kind.simpleString()}")
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def round_at(x: Column, mode: str, digit: int) -> Column:
    """Round at a digit position: 1 and 0 give integers, 2 one decimal, -2 hundreds.

    ``R`` rounds half towards plus infinity, ``RU`` up, ``RD`` down. Spark's own
    ``round`` moves halves away from zero and works on the decimal text.
    """
    scale = 10.0 ** (digit - 1 if digit > 0 else -digit)
    y = x * scale if digit > 0 else x / scale
    if mode == "RU":
        whole = F.ceil(y)
    elif mode == "RD":
        whole = F.floor(y)
    else:
        # y - floor(y) is exact where floor(y + 0.5) is not.
        whole = F.floor(y) + F.when(y - F.floor(y) >= 0.5, 1).otherwise(0)
    # floor and ceil return BIGINT, which NaN and huge values do not fit.
    g = F.when(F.abs(y) < WHOLE, whole.cast("double")).otherwise(y)
    back = g / scale if digit > 0 else g * scale
    return F.when(F.abs(y) < float("inf"), back).otherwise(x)


def is_outlier(x: Column, mean: Column, sd: Column, k: float = 1.0) -> Column:
    """Strictly outside mean ± k·sd; never true if any of the three is NaN.

    Spark sorts NaN above every number, hence the two guards. NULL statistics
    (no numeric cell) give NULL.
    """
    reach = sd * F.lit(k)
    lower, upper = mean - reach, mean + reach
    return ((x < lower) & ~F.isnan(lower)) | ((x > upper) & ~F.isnan(x))


def draw(seed: int | None = None, identity: Sequence[Column] = ()) -> Column:
    """Uniform in [0, 1), drawn afresh for every cell.

    With the cells that tell a row from others, it is a function of them and
    the seed alone: the same row gets the same number in whatever task and order.
    """
    if not identity:
        return F.rand() if seed is None else F.rand(seed)
    if seed is None:
        seed = random.getrandbits(62)
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11) * 2.0**-53


def random_number(low: Column, high: Column, drawn: Column) -> Column:
    """Uniform in [low, high), by a number drawn from [0, 1)."""
    return low + (high - low) * drawn
