"""Apply a policy to a table: one projection, plus statistics if it needs any."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions import (
    draw,
    free_name,
    has_numbers,
    hmac_sha256,
    is_outlier,
    matches,
    named,
    part_delete,
    random_number,
    random_text,
    require_columns,
    round_at,
    sha256_hex,
    span_mask,
    to_number,
)
from veilframe.operators.profiling import field, statistics_row
from veilframe.plans import Policy, Treatment
from veilframe.sources.tables import with_place

STATISTICS = "__statistics"
NUMBER_OF = "__number:"
# What a column of integers becomes where some of its cells are replaced by a mean.
INTEGERS = ("text", "round")


@dataclass(frozen=True)
class Choices:
    """What a treatment's column does not say itself: its seed, the row's identity, the form of means."""

    seed: int | None = None
    identity: tuple[Column, ...] = ()
    integers: str = "text"


def _as_cell(df: DataFrame, treatment: Treatment, value: Column) -> Column:
    """A number as the column holds it: text for text columns, else a double.

    A text cell that is no number becomes empty text; a NULL cell stays NULL.
    """
    if not isinstance(df.schema[treatment.column].dataType, T.StringType):
        return value
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(named(treatment.column).isNotNull(), text)


def _number(df: DataFrame, treatment: Treatment) -> Column:
    """The cell as a double, parsed once by the projection below if it is text."""
    kind = df.schema[treatment.column].dataType
    if isinstance(kind, T.StringType):
        return named(NUMBER_OF + treatment.column)
    return to_number(named(treatment.column), kind)


def _figure(treatment: Treatment, figure: str) -> Column:
    return F.col(STATISTICS).getField(field(treatment, figure))


def _masking(df: DataFrame, t: Treatment, how: Choices) -> Column:
    return span_mask(named(t.column), t.spec)


def _part_delete(df: DataFrame, t: Treatment, how: Choices) -> Column:
    return part_delete(named(t.column), t.spec)


def _round(df: DataFrame, t: Treatment, how: Choices) -> Column:
    return _as_cell(df, t, round_at(_number(df, t), t.mode, t.digit))


def _encryption(df: DataFrame, t: Treatment, how: Choices) -> Column:
    if t.key:
        return F.lower(F.hex(hmac_sha256(named(t.column).cast("string"), t.key.encode())))
    return sha256_hex(named(t.column), t.salt)


def _mean_cell(kind: T.DataType, mean: Column, integers: str) -> tuple[T.DataType, Column]:
    """A type that prints a cell of ``kind`` as it was, and the mean in that type."""
    if isinstance(kind, T.DecimalType):
        return kind, mean.cast(kind)
    if not isinstance(kind, T.IntegralType):
        return T.DoubleType(), mean
    if integers == "round":
        return kind, round_at(mean, "R", 1).cast(kind)
    return T.StringType(), mean.cast("string")


def _outliers(df: DataFrame, t: Treatment, how: Choices) -> Column:
    """TopBottom, and MicroAggregation for the rows that meet its conditions."""
    x, mean, sd = _number(df, t), _figure(t, "Avg"), _figure(t, "Sd")
    original = named(t.column)
    if isinstance(df.schema[t.column].dataType, T.StringType):
        # Cells that stay keep their own spelling.
        treated = (
            F.when(is_outlier(x, mean, sd), mean.cast("string"))
            .when(original.isNotNull() & x.isNull(), F.lit(""))
            .otherwise(original)
        )
    else:
        kind, mean_cell = _mean_cell(df.schema[t.column].dataType, mean, how.integers)
        original = original.cast(kind)
        treated = F.when(is_outlier(x, mean, sd), mean_cell).otherwise(original)
    if not t.conditions:
        return treated
    return F.when(matches(df, t.conditions), treated).otherwise(original)


def _random(df: DataFrame, t: Treatment, how: Choices) -> Column:
    """A number within the column's range, or a text of the cell's length."""
    seeds = random.Random(how.seed)
    kind = df.schema[t.column].dataType
    if not has_numbers(kind):
        # A date or a flag is no number: a text of the length it prints with.
        return random_text(named(t.column).cast("string"), seeds.getrandbits(62), how.identity)
    drawn = random_number(_figure(t, "Min"), _figure(t, "Max"), draw(seeds.getrandbits(62), how.identity))
    x = _number(df, t)
    if not isinstance(kind, T.StringType):
        return F.when(x.isNotNull(), drawn)
    text = random_text(named(t.column), seeds.getrandbits(62), how.identity)
    return F.when(x.isNotNull(), _as_cell(df, t, drawn)).otherwise(text)


BUILDERS = {
    "Masking": _masking,
    "PartDelete": _part_delete,
    "Round": _round,
    "Encryption": _encryption,
    "TopBottom": _outliers,
    "MicroAggregation": _outliers,
    "Random": _random,
}


def _stored_row(stored: DataFrame, policy: Policy, kinds: T.StructType) -> DataFrame:
    """The one-row form of statistics kept as ``profile`` returns them.

    A figure that is not there, that is of rows under other conditions, or that
    is there more than once fails the query: cells would be measured by it, or
    pass through as they are.
    """
    require_columns(stored, ["column", "stat", "conditions", "value"], "the stored statistics")
    figures = []
    for t in policy.measured:
        if not has_numbers(kinds[t.column].dataType):
            continue
        for figure in t.needed_figures:
            conditions = F.coalesce("conditions", F.lit(""))
            found = (F.col("column") == t.column) & (F.col("stat") == figure)
            found = found & (conditions == t.condition_text)
            name = f"{figure} of {t.column}" + (f" where {t.condition_text}" if t.conditions else "")
            missing = F.raise_error(F.lit(f"no stored {name}")).cast("double")
            double = F.raise_error(F.lit(f"more than one stored {name}")).cast("double")
            value = (
                F.when(F.count_if(found) == 0, missing)
                .when(F.count_if(found) > 1, double)
                .otherwise(F.max(F.when(found, F.col("value"))))
            )
            figures.append(value.alias(field(t, figure)))
    return stored.agg(*figures)


def pseudonymize(
    df: DataFrame,
    policy: Policy,
    seed: int | None = None,
    statistics: DataFrame | None = None,
    integers: str = "text",
    identity: Sequence[str] | str = (),
) -> DataFrame:
    """``df`` with every treated column replaced, in the same column order.

    Without TopBottom, MicroAggregation or Random this is one narrow
    projection. Otherwise the statistics come first: an aggregate over the
    treated and tested columns, whose single row reaches the projection as a
    scalar subquery, so no join is planned. ``statistics`` takes a stored
    result of ``profile`` instead and leaves out that scan.

    Text columns stay text; numeric columns under a numeric treatment become
    doubles, but under TopBottom and MicroAggregation a cell that stays must
    print as it did: a decimal keeps its type, with the mean rounded to its
    places, and a column of integers becomes text, in which 4 stays ``4`` and
    the mean has its fraction. ``integers="round"`` leaves such a column its
    type and rounds the mean, halves up. Under Random, columns that are neither
    numbers nor text become text. ``seed`` makes Random repeatable for the same
    input partitions; with ``identity``, the columns that tell rows apart, it does
    so for any partitions and order, and rows alike in all of them draw alike.
    ``identity="row"`` stands for a row's place in its Parquet file; a table that
    is not read straight from such files is stored first, which only a stored
    table can repeat.
    """
    require_columns(df, policy.columns)
    place = []
    if identity == "row":
        place = [free_name("place", df)]
        df = with_place(df, place[0])
    elif isinstance(identity, str):
        raise ValueError(f"identity is a list of columns or 'row', not {identity!r}")
    require_columns(df, identity if not place else place)
    of = tuple(named(name) for name in place or identity)
    if integers not in INTEGERS:
        raise ValueError(f"integers is one of {INTEGERS}, not {integers!r}")
    treated = {t.column: t for t in policy.treatments}
    kept = [
        name
        for name in df.columns
        if name not in place and (name not in treated or treated[name].kind != "Delete")
    ]

    columns = []
    for name in kept:
        if name not in treated:
            columns.append(named(name))
            continue
        own_seed = None if seed is None else random.Random(f"{seed}/{name}").getrandbits(62)
        treatment = treated[name]
        how = Choices(own_seed, of, integers)
        columns.append(BUILDERS[treatment.kind](df, treatment, how).alias(name))

    prepared = [
        to_number(named(t.column), T.StringType()).alias(NUMBER_OF + t.column)
        for t in policy.treatments
        if t.numeric and isinstance(df.schema[t.column].dataType, T.StringType)
    ]
    measured = [
        t
        for t in policy.measured
        if t.kind != "Random" or has_numbers(df.schema[t.column].dataType)
    ]
    if measured:
        if statistics is None:
            row = statistics_row(df, [(t, t.needed_figures) for t in measured])
        else:
            row = _stored_row(statistics, policy, df.schema)
        # One struct, read once: naming the subquery in every treatment
        # would plan it once per use.
        packed = row.select(F.struct(*[named(c) for c in row.columns]))
        prepared.append(packed.scalar().alias(STATISTICS))
    return df.select("*", *prepared).select(*columns)
