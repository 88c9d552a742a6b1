"""Column statistics, all of them from one scan and one aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import has_numbers, matches, named, require_columns, to_number
from veilframe.plans import Policy, Treatment

AGGREGATES = {
    "Count": F.count,
    "Avg": F.avg,
    "Sd": F.stddev_pop,
    "Variance": F.var_pop,
    "Min": F.min,
    "Max": F.max,
}


def field(treatment: Treatment, figure: str) -> str:
    """The name a column's figure has in the one-row form."""
    return f"{figure}({treatment.column})"


def statistics_row(
    df: DataFrame, requests: Iterable[tuple[Treatment, Sequence[str]]]
) -> DataFrame:
    """One row with every requested figure, named by ``field``.

    Only numeric cells count, NaN excepted. A treatment with conditions uses
    the rows that meet them; if every treatment has some, rows that meet none
    are filtered out in the scan. Each task sends one row of partial results,
    whatever the size of the table.
    """
    requests = list(requests)
    conditions = [t.conditions for t, _ in requests]
    if all(conditions):
        df = df.filter(reduce(or_, [matches(df, c) for c in dict.fromkeys(conditions)]))

    numbers, figures = [], []
    for i, (treatment, wanted) in enumerate(requests):
        kind = df.schema[treatment.column].dataType
        if treatment.kind == "Random" and not has_numbers(kind):
            number = F.lit(None).cast("double")
        else:
            number = F.nanvl(to_number(named(treatment.column), kind), F.lit(None))
        if treatment.conditions:
            number = F.when(matches(df, treatment.conditions), number)
        numbers.append(number.alias(f"n{i}"))
        figures += [AGGREGATES[f](f"n{i}").alias(field(treatment, f)) for f in wanted]
    return df.select(*numbers).agg(*figures)


def profile(
    df: DataFrame, policy: Policy, figures: Sequence[str] | None = None
) -> DataFrame:
    """``(column, stat, conditions, value)`` for the policy's statistics-driven columns.

    ``conditions`` says of which rows the figure is, so that it is not taken
    for that of others: ``column=value`` joined by ``&`` and escaped as in a web
    address, empty for all rows.

    The figures are ``figures`` if given, else the policy's profile request,
    else those each column's treatment needs. Besides the four figures of a
    policy, ``Count`` gives the number of numeric cells.
    """
    if not policy.measured:
        raise ValueError("the policy has no TopBottom, MicroAggregation or Random column")
    require_columns(df, policy.columns)
    chosen = tuple(figures or policy.figures)
    requests = [(t, chosen or t.needed_figures) for t in policy.measured]
    rows = [
        F.struct(
            F.lit(t.column).alias("column"),
            F.lit(figure).alias("stat"),
            F.lit(t.condition_text).alias("conditions"),
            named(field(t, figure)).cast("double").alias("value"),
        )
        for t, wanted in requests
        for figure in wanted
    ]
    return statistics_row(df, requests).select(F.inline(F.array(*rows)))


MOMENTS = ("Count", "Avg", "Variance", "Min", "Max")
PART_COLUMNS = ["column", "conditions", "n", "mean", "m2", "low", "high"]


def moments(df: DataFrame, policy: Policy) -> DataFrame:
    """``(column, conditions, n, mean, m2, low, high)`` for the policy's statistics-driven columns.

    The figures of one part of a table, from one scan of it, in a form that
    ``merged`` puts together: ``m2`` is the sum of squared distances to the mean.
    """
    if not policy.measured:
        raise ValueError("the policy has no TopBottom, MicroAggregation or Random column")
    require_columns(df, policy.columns)
    rows = []
    for t in policy.measured:
        n, mean, variance, low, high = (named(field(t, figure)).cast("double") for figure in MOMENTS)
        cells = [F.lit(t.column), F.lit(t.condition_text), n.cast("long"), mean, variance * n, low, high]
        rows.append(F.struct(*[cell.alias(name) for cell, name in zip(cells, PART_COLUMNS)]))
    return statistics_row(df, [(t, MOMENTS) for t in policy.measured]).select(F.inline(F.array(*rows)))


def merged(parts: DataFrame) -> DataFrame:
    """One row a column and conditions from the ``moments`` of any number of parts.

    Counts and extremes add up as they are; to the parts' own squared distances
    comes that of each part's mean to the mean of all, once a row. Differences
    of means are squared, not means, so nothing cancels.
    """
    require_columns(parts, PART_COLUMNS, "the moments")
    on = ["column", "conditions"]
    some = parts.filter("n > 0")
    whole = some.groupBy(*on).agg(
        F.sum("n").alias("total"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("centre")
    )
    spread = F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2
    # Figures of parts without a numeric cell are there as well, as NULL.
    return (
        parts.join(whole, on, "left")
        .groupBy(*on)
        .agg(
            F.sum("n").alias("n"),
            F.first("centre", ignorenulls=True).alias("mean"),
            F.sum(spread).alias("m2"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )


def figures_of(found: DataFrame, figures: Sequence[str] = ("Avg", "Sd", "Min", "Max")) -> DataFrame:
    """``merged`` moments as ``profile`` returns them, ready for ``pseudonymize(statistics=...)``."""
    values = {
        "Count": F.col("n").cast("double"),
        "Avg": F.col("mean"),
        "Sd": F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0))),
        "Min": F.col("low"),
        "Max": F.col("high"),
    }
    rows = F.array(*[F.struct(F.lit(f).alias("stat"), values[f].alias("value")) for f in figures])
    found = found.select("column", "conditions", F.explode(rows).alias("figure"))
    return found.select("column", "figure.stat", "conditions", "figure.value")
