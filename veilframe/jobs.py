"""The three jobs, from paths to paths."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import figures_of, link, merged, moments, profile, pseudonymize
from veilframe.plans import LinkSpec, Policy
from veilframe.plans.policy import FIGURES
from veilframe.sources import (
    read_link_spec,
    read_policy,
    read_secret,
    read_table,
    refused_records,
    scratch,
    stored,
    write_table,
)


def run_profile(
    spark: SparkSession, table: str, policy: str, output: str, format: str = "csv", parts: str | None = None
) -> DataFrame:
    """Write the statistics a policy asks for and return the report.

    With ``parts`` the table is one part of a larger one. Its moments are kept
    in that folder, in place of those of an earlier run over the same path, and
    the report is of all parts kept there; only the new part is read.
    """
    source, rules = read_table(spark, table, format), read_policy(spark, policy)
    if parts is None:
        found = profile(source, rules)
    else:
        name = hashlib.sha256(table.encode()).hexdigest()
        write_table(moments(source, rules).coalesce(1), f"{parts}/part={name}", "parquet", mode="overwrite")
        kept = spark.read.parquet(parts)
        figures = figures_of(merged(_whole(kept)), FIGURES)
        asked = [
            (t.column, figure, t.condition_text)
            for t in rules.measured
            for figure in rules.figures or t.needed_figures
        ]
        asked = spark.createDataFrame(asked, "column string, stat string, conditions string")
        found = figures.join(F.broadcast(asked), ["column", "stat", "conditions"], "left_semi")
    # A row per figure: one file.
    write_table(found.coalesce(1), output, format)
    return read_table(spark, output, format)


def _whole(kept: DataFrame) -> DataFrame:
    """The moments of all parts; a figure that some part lacks is an error, as it would be of the others only."""
    total = kept.select(F.count_distinct("part")).scalar()
    have = kept.groupBy("column", "conditions").agg(F.count_distinct("part").alias("have"))
    name = F.concat_ws(" where ", "column", F.nullif(F.col("conditions"), F.lit("")))
    lacking = F.raise_error(F.concat(F.lit("some parts have no moments of "), name)).cast("boolean")
    have = have.filter(F.when(F.col("have") == total, F.lit(True)).otherwise(lacking))
    return kept.join(have.drop("have"), ["column", "conditions"])


def run_pseudonymize(
    spark: SparkSession,
    table: str,
    policy: str,
    output: str,
    format: str = "csv",
    seed: int | None = None,
    statistics: str | None = None,
    integers: str = "text",
    refused: str | None = None,
    identity: list[str] | None = None,
) -> None:
    """Write the treated table; ``statistics`` is the output of a profile job.

    A record with more cells than the header ends the job, unless ``refused``
    names a folder: such records are then left out of the statistics and of the
    result and written there as quoted text, with their file and line. The table
    is read for them only if the job has counted any. ``identity`` names the
    columns by which a seed repeats random cells whatever the partitions.
    """
    rules, stored = read_policy(spark, policy), None
    if statistics is not None:
        stored = read_table(spark, statistics, format)
        stored = stored.withColumn("value", stored["value"].try_cast("double"))
    count = Observation() if refused is not None and format == "csv" else None
    source = read_table(spark, table, format, refused=count)
    write_table(pseudonymize(source, rules, seed, stored, integers, identity or ()), output, format)
    if refused is not None:
        records = refused_records(spark, table) if count is not None and count.get["records"] else None
        if records is None:
            records = spark.createDataFrame([], "file string, line long, record string")
        write_table(records, refused, quote='"')


def run_link(
    spark: SparkSession,
    table_a: str,
    table_b: str,
    spec: str,
    output: str,
    format: str = "csv",
    header: bool = True,
    key_mode: str = "columns",
    drop_empty_keys: bool = False,
    split_hot_keys: bool = False,
    secret: str | None = None,
) -> None:
    """Write the linked columns, by default with a header line, as ``read_table`` needs it.

    ``secret`` is the path of a file whose bytes are the secret of keyed tokens.
    """
    options = {"key_mode": key_mode, "drop_empty_keys": drop_empty_keys}
    if secret is not None:
        options["secret"] = read_secret(spark, secret)
    a, b = read_table(spark, table_a, format), read_table(spark, table_b, format)
    with scratch(spark):
        linked = link(a, b, read_link_spec(spark, spec, **options), split_hot_keys)
        write_table(linked, output, format, header=header)


def link_and_pseudonymize(
    a: DataFrame,
    b: DataFrame,
    spec: LinkSpec,
    policy: Policy,
    output: str,
    format: str = "parquet",
    seed: int | None = None,
    split_hot_keys: bool = False,
) -> None:
    """Write the linked and treated table.

    The treatment reads the link twice, so the link is stored in between, in
    clear; it is removed once the result is written, or if that fails.
    """
    with scratch(a.sparkSession), stored(link(a, b, spec, split_hot_keys)) as linked:
        write_table(pseudonymize(linked, policy, seed), output, format)
