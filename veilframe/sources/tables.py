"""Reading and writing tables.

The text format is one record per line, cells separated by commas, a header
line in every file, UTF-8, and no quoting: a quotation mark is data.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions import named

SEPARATOR = ","
RECORD = "__record"


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    schema: T.StructType | None = None,
    quote: str = "",
    recursive: bool | None = None,
    refused: Observation | None = None,
) -> DataFrame:
    """A directory of files as one table.

    Sub-directories are included for text. Other formats read them as
    partitions of the table, unless ``recursive`` says otherwise.

    Text cells are strings and an empty cell is the empty string. Records that
    lack trailing cells are filled up with empty ones; a record with more cells
    than the header is an error, since its cells may have moved into columns
    they do not belong to. A file whose header differs from the first file's is
    an error as well. A blank line is an empty cell of a table with one column
    and no record of any other. With ``schema`` no file is opened to plan the
    read.

    With ``refused`` records with more cells are set aside instead: they are left
    out, the observation counts them as ``records``, and ``refused_records``
    returns them with their places. The count is there once a job has read the
    whole table.
    """
    if recursive is None:
        recursive = format == "csv"
    reader = spark.read.option("recursiveFileLookup", recursive)
    if format != "csv":
        return (reader.schema(schema) if schema is not None else reader).format(format).load(path)
    options = _csv_options(quote)
    if schema is None:
        schema = reader.csv(path, **options).schema
    if len(schema) == 1 and not quote:
        return _one_column(reader, path, schema[0], refused)
    whole = T.StructType([*schema, T.StructField(RECORD, T.StringType())])
    # Without pruning, a record is compared with the header however few columns are asked for.
    reader = reader.schema(whole).option("columnPruning", False)
    table = reader.csv(path, columnNameOfCorruptRecord=RECORD, **options)
    surplus = F.coalesce(_surplus(F.col(RECORD), len(schema), quote), F.lit(False))
    # The first column is named too: the reader does not give a record alone.
    fine = F.coalesce(F.length(named(schema[0].name).cast("string")), F.lit(0)) >= 0
    return _without_surplus(table, surplus, F.col(RECORD), fine, refused).drop(RECORD).na.fill("")


def _csv_options(quote: str) -> dict:
    return {
        "header": True,
        "sep": SEPARATOR,
        "quote": quote,
        "escape": quote or "\\",
        "encoding": "UTF-8",
        "enforceSchema": False,
    }


def _surplus(record: Column, width: int, quote: str) -> Column:
    """Whether a line has more cells than the header."""
    cells = F.regexp_replace(record, f"{quote}([^{quote}]|{quote}{quote})*{quote}", "") if quote else record
    return F.size(F.split(cells, SEPARATOR, -1)) > width


def _without_surplus(
    table: DataFrame, surplus: Column, record: Column, fine: Column, refused: Observation | None
) -> DataFrame:
    """The other records; those with surplus cells are counted, or an error."""
    if refused is not None:
        return table.observe(refused, F.count_if(surplus).alias("records")).filter(~surplus & fine)
    message = F.concat(F.lit("a record has more cells than the header: "), record)
    # A filter, which also a count of the rows goes through.
    return table.filter(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(fine))


def refused_records(
    spark: SparkSession, path: str, quote: str = "", recursive: bool = True
) -> DataFrame:
    """``(file, line, record)`` of a text table's records with more cells than the header.

    Lines are counted from 1, the header's, blank ones included. The lines of
    every block of a file are counted where they are read, and there is one
    count a block, so the job moves no more than the records it returns.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    width = len(reader.csv(path, **_csv_options(quote)).schema)
    source, split = F.col("_metadata"), ["file", "block"]
    lines = reader.text(path).select(
        F.col("value").alias("record"),
        source["file_path"].alias("file"),
        source["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    blocks = lines.groupBy(*split).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    found = lines.filter(_surplus(F.col("record"), width, quote)).join(blocks, split)
    line = F.col("before") + F.col("at") - F.col("first") + 1
    return found.select("file", line.alias("line"), "record")


def _one_column(reader, path: str, field: T.StructField, refused: Observation | None) -> DataFrame:
    """A table of one unquoted column, line by line, since blank lines are cells."""
    source = F.col("_metadata")
    lines = reader.text(path).select(
        F.col("value"),
        source["file_path"].alias("file"),
        source["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    # The first line of each file, one row a file.
    heads = lines.filter("block = 0").groupBy("file").agg(F.min(F.struct("line", "value")).alias("head"))
    other = F.concat(F.lit("a file has another header: "), F.col("head.value"))
    same = F.when(F.col("head.value") != field.name, F.raise_error(other).cast("long")).otherwise(F.col("head.line"))
    records = lines.join(heads.select(same.alias("line")), "line", "left_anti")
    record = F.col("value")
    records = _without_surplus(records, record.contains(SEPARATOR), record, F.lit(True), refused)
    cell = F.col("value")
    if not isinstance(field.dataType, T.StringType):
        cell = cell.try_cast(field.dataType)
    return records.select(cell.alias(field.name))


# Types whose text never holds a separator or a line break.
PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _printable(field: T.StructField, quote: str) -> Column:
    """The cell's text, refused if it would break its line of the file."""
    text = F.coalesce(named(field.name).cast("string"), F.lit(""))
    if isinstance(field.dataType, PLAIN):
        return text.alias(field.name)
    broken = text.contains("\n") | text.contains("\r")
    if not quote:
        broken = broken | text.contains(SEPARATOR)
    message = f"a cell of {field.name} holds a line break, or a separator and no quote is set"
    refused = F.raise_error(F.lit(message)).cast("string")
    return F.when(broken, refused).otherwise(text).alias(field.name)


def write_table(
    df: DataFrame,
    path: str,
    format: str = "csv",
    header: bool = True,
    quote: str = "",
    mode: str = "errorifexists",
) -> None:
    """Write a table; the directory must be new unless ``mode`` says otherwise.

    Without ``quote`` the files are what ``read_table`` reads by default. A cell
    that the lines cannot hold fails the write instead of shifting columns.
    """
    if format != "csv":
        df.write.format(format).mode(mode).save(path)
        return
    df = df.select(*[_printable(field, quote) for field in df.schema])
    if len(df.columns) == 1 and not quote:
        write_lines(df, path, header, mode)
        return
    df.write.mode(mode).csv(
        path,
        header=header,
        sep=SEPARATOR,
        quote=quote,
        escape=quote,
        emptyValue="",
        nullValue="",
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_lines(df: DataFrame, path: str, header: bool, mode: str = "errorifexists") -> None:
    """A table of one unquoted column: its cells as lines, as they are, behind its name.

    Spark's writer of records would leave out empty ones.
    """
    name = df.columns[0]
    lines = df.select(named(name).alias("value"))
    if header:
        # The first row of each task, and so of each file, comes behind the name,
        # and a file of the name alone serves a table without rows.
        head, first = F.lit(name), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        lines = lines.select(F.explode(F.when(first, F.array(head, "value")).otherwise(F.array("value"))).alias("value"))
        lines = lines.union(df.sparkSession.range(0, 1, 1, 1).select(head))
    lines.write.mode(mode).option("maxRecordsPerFile", 0).text(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of a table's size, by that of its files; no job runs for it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session may go without one; every executor of a cluster has
    to see the folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="veilframe-")


# What ``materialize`` has stored since each open ``scratch`` block began, innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    For a result that several scans will read, such as a link that a
    statistics-driven policy follows: it is computed once, later scans read
    only the columns they use, and a lost executor costs no recomputation.
    Within a ``scratch`` block the table is removed at its end; ``keep`` leaves
    it to the block around that one.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    blocks = _blocks.get()
    for block in blocks[: len(blocks) - keep][-1:]:
        block.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove behind the block what was materialized in it.

    Whatever still reads those tables must have been written, or materialized
    with ``keep``, within the block.
    """
    paths: list[str] = []
    before = _blocks.set((*_blocks.get(), paths))
    try:
        yield
    finally:
        _blocks.reset(before)
        for path in paths:
            remove(spark, path)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``materialize`` for the time of a block: what was stored is removed behind it.

    For a table in clear that only an intermediate step reads. Results must be
    written within the block.
    """
    with scratch(df.sparkSession):
        yield materialize(df)


# Steps of a plan that give each row of a file once, in the file's own terms.
NARROW = ("Project", "Filter", "SubqueryAlias")


def straight_from_files(df: DataFrame) -> bool:
    """Whether the rows are those of one table's files, each at most once."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in NARROW:
        plan = plan.children().head()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def with_place(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a long that tells its rows apart, equal ones too: a hash of file and row number.

    It does not depend on how the files are split into tasks, nor on the order
    in which a shuffle delivers rows, so a task that runs again gives a row the
    same one. Rows read straight from Parquet files have it already; any other
    table is stored first, in the columns that it has.
    """

    def placed(files: DataFrame) -> DataFrame:
        source = files.metadataColumn("_metadata")
        return files.select("*", F.xxhash64(source["file_path"], source["row_index"]).alias(name))

    if straight_from_files(df):
        try:
            return placed(df)
        except AnalysisException:
            # Other formats do not number their rows.
            pass
    return placed(materialize(df))
