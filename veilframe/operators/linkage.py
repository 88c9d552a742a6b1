"""Inner join of two tables on a hashed composite key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions import link_token, named, require_columns
from veilframe.plans import LinkSpec
from veilframe.sources.tables import estimated_bytes, materialize, scratch, with_place

TOKEN = "__token"
PLACE = "__place"
# A key whose pairs are more than this is dealt out to several tasks.
PAIRS_PER_CELL = 1_000_000
# Hot keys beyond this number are not broadcast; a row of the list is 28 bytes.
BROADCAST_KEYS = 1_000_000
# Keys are first counted by bins of their hash; the list of bins is 8 bytes each.
BINS = 1 << 20


def _printed_kind(kind: T.DataType) -> str:
    """Types that print equal values alike share a name."""
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, T.DecimalType):
        return f"decimal with {kind.scale} places" if kind.scale else "integer"
    return kind.simpleString()


def _require_comparable(a: DataFrame, b: DataFrame, spec: LinkSpec) -> None:
    """Keys are compared as text, in which 1 and 1.0 differ: refuse such pairs of columns."""
    if spec.tokens or len(spec.keys_a) != len(spec.keys_b):
        return
    for x, y in zip(spec.keys_a, spec.keys_b):
        kinds = [_printed_kind(df.schema[name].dataType) for df, name in ((a, x), (b, y))]
        if "string" not in kinds and kinds[0] != kinds[1]:
            raise ValueError(f"{x} is {kinds[0]} and {y} is {kinds[1]}, which never print alike; cast one of them")


def _ready_token(df: DataFrame, name: str) -> Column:
    """A token as it came, text or bytes; one of another length is an error."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.StringType, T.BinaryType)):
        raise ValueError(f"{name} holds no tokens, it is {kind.simpleString()}")
    cell = named(name)
    token = F.try_to_binary(cell, F.lit("hex")) if isinstance(kind, T.StringType) else cell
    refused = F.raise_error(F.lit(f"a cell of {name} is no token of 32 bytes")).cast("binary")
    return F.when(cell.isNull() | (F.octet_length(token) == 32), token).otherwise(refused)


def _side(df: DataFrame, side: str, spec: LinkSpec) -> DataFrame:
    """The token and the wanted columns, under names of this side only."""
    keys, columns = (spec.keys_a, spec.columns_a) if side == "A" else (spec.keys_b, spec.columns_b)
    if side in spec.tokens:
        token = _ready_token(df, keys[0])
    else:
        if spec.drop_empty_keys:
            df = df.filter(reduce(or_, [named(k).cast("string") != "" for k in keys]))
        token = link_token([named(k) for k in keys], spec.key_mode, spec.secret)
    return df.select(
        token.alias(TOKEN), *[named(name).alias(f"{side.lower()}{i}") for i, name in enumerate(columns)]
    )


def tokenise(
    df: DataFrame, keys: Sequence[str], token: str, key_mode: str = "columns", secret: bytes = b""
) -> DataFrame:
    """``df`` with the key columns replaced by one of tokens, as hexadecimal text, in front.

    What one owner hands to another, who links it as ``tokens`` of a link spec
    without seeing a key. Both must use the same mode and secret.
    """
    require_columns(df, keys)
    rest = [name for name in df.columns if name not in keys]
    if token in rest:
        raise ValueError(f"the table has a column {token} already")
    made = F.lower(F.hex(link_token([named(k) for k in keys], key_mode, secret)))
    return df.select(made.alias(token), *map(named, rest))


def _output_names(spec: LinkSpec) -> list[str]:
    """A's names, then B's; a name on both sides gets ``_a`` and ``_b``."""
    shared = set(spec.columns_a) & set(spec.columns_b)
    names = [c + "_a" if c in shared else c for c in spec.columns_a]
    names += [c + "_b" if c in shared else c for c in spec.columns_b]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"the link would return {repeated} more than once")
    return names


def _keyed(side: DataFrame) -> DataFrame:
    key = F.xxhash64(TOKEN)
    return side.select(key.alias("key"), F.pmod(key, F.lit(BINS)).alias("bin"))


def _candidates(short: DataFrame, long: DataFrame, pairs_per_cell: int) -> DataFrame:
    """``(bin)``: the bins that may hold a key with more pairs than a cell is to have.

    ``short`` has the exact counts ``(key, bin, n)`` of one side; of the other the
    rows of each bin are counted, which bound those of every key in it. Bins
    are added up by the tasks, so a task sends ``BINS`` counts at most however
    many keys it reads, and no hot key is missed.
    """
    most = short.groupBy("bin").agg(F.max("n").alias("most"))
    rows = long.groupBy("bin").agg(F.count("*").alias("rows"))
    possible = F.col("most").cast("double") * F.col("rows") > pairs_per_cell
    return most.join(rows, "bin").filter(possible).select("bin")


def hot_keys(left: DataFrame, right: DataFrame, pairs_per_cell: int) -> DataFrame:
    """``(key, pieces_a, pieces_b)``, stored: keys with more pairs than a cell is to have.

    A key's pairs are the product of its rows on both sides: it need not be
    frequent on either side alone. The smaller side is counted by key. The
    larger one is first counted by bins, and only the keys of bins that can hold
    a hot one are counted exactly, so that as a rule it is read once, narrow, and
    its keys are not shuffled. There cannot be more hot keys than the result
    has cells. The grid is cut so that it copies few rows: the longer side is
    cut more often.
    """
    swapped = estimated_bytes(left) < estimated_bytes(right)
    short, long = (_keyed(side) for side in ((left, right) if swapped else (right, left)))
    with scratch(left.sparkSession):
        short = materialize(short.groupBy("key", "bin").agg(F.count("*").alias("n")))
        bins = materialize(_candidates(short, long, pairs_per_cell))
        # There are BINS of them at most.
        chosen = long.join(F.broadcast(bins), "bin", "left_semi")
        counted = chosen.groupBy("key").agg(F.count("*").alias("rows")).join(short, "key")
        sides = ("n", "rows") if swapped else ("rows", "n")
        a, b = (F.col(name).cast("double") for name in sides)
        cells = a * b / pairs_per_cell
        pieces_a = F.least(a, F.greatest(F.lit(1.0), F.ceil(F.sqrt(cells * a / b))))
        pieces_b = F.least(b, F.greatest(F.lit(1.0), F.ceil(cells / F.col("pieces_a"))))
        found = counted.filter(cells > 1).withColumn("pieces_a", pieces_a)
        found = found.select("key", F.col("pieces_a").cast("int"), pieces_b.cast("int").alias("pieces_b"))
        return materialize(found, keep=True)


def _counted(side: DataFrame, rows: str) -> DataFrame:
    """Rows alike in every column once, with their number as ``rows``."""
    return side.groupBy(*side.columns).agg(F.count("*").alias(rows))


def _split_hot_keys(
    left: DataFrame, right: DataFrame, pairs_per_cell: int, counted: bool = False
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with a grid cell added to the join key of hot keys.

    A hot key's rows are dealt out to ``pieces_a`` × ``pieces_b`` cells. Each
    row has a fixed piece number of its own side and a copy for every piece of
    the other, so each pair meets in exactly one cell. The piece number comes
    from the row's place in its file, so rows that are equal in all wanted
    columns part as well, and a task that is run again deals as before; a random
    number, or one by order of arrival, would lose or double pairs when part of
    a stage is recomputed. With ``counted`` the like rows of a piece are counted
    as soon as they are dealt, before they are copied.
    """
    left, right = with_place(left, PLACE), with_place(right, PLACE)
    # Stored: both sides must see the same list, and a broadcast that had to
    # scan two tables first could run into Spark's broadcast timeout.
    hot = hot_keys(left, right, pairs_per_cell)
    if hot.count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        columns = [name for name in side.columns if name != PLACE]
        found = side.withColumn("key", F.xxhash64(TOKEN)).join(hot, "key", "left")
        pieces = F.coalesce(F.col(f"pieces_{own}"), F.lit(1))
        copies = F.coalesce(F.col(f"pieces_{other}"), F.lit(1))
        found = found.select(
            *columns, F.pmod(PLACE, pieces).cast("int").alias(f"cell_{own}"), copies.alias("copies")
        )
        if counted:
            found = _counted(found, f"rows_{own}")
        cells = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias(f"cell_{other}")
        return found.select(*[name for name in found.columns if name != "copies"], cells)

    return dealt(left, "a", "b"), dealt(right, "b", "a"), [TOKEN, "cell_a", "cell_b"]


def link(
    a: DataFrame,
    b: DataFrame,
    spec: LinkSpec,
    split_hot_keys: bool = False,
    pairs_per_cell: int = PAIRS_PER_CELL,
    pairs: str = "",
) -> DataFrame:
    """Every pair of an A row and a B row with equal keys, many to many.

    Keys are hashed before any shuffle, so clear keys reach neither shuffle
    files nor the result. They are compared as text; two columns of types that
    print equal values differently are refused. The join is left to Spark: it
    broadcasts a side that it measures to be small and otherwise sorts and
    merges, spilling to disk. Adaptive execution splits a partition that one
    hot key has made large, on both sides if need be; it goes by bytes of
    input, and needs ``spark.shuffle.accurateBlockSkewedFactor`` beyond 2000
    shuffle partitions (``veilframe.session.SETTINGS``).

    ``split_hot_keys`` spreads hot keys in the plan itself, by the pairs they
    make: a key with more than ``pairs_per_cell`` is dealt out to cells of about
    that many, whatever the size of the table, however its rows lie and however
    alike they are. For this a job runs at once that counts the rows of every
    key on both sides and stores the list of hot ones in the shared folder. A
    side that is not read straight from Parquet files is stored there too,
    tokens and wanted columns only, since its rows must have fixed places.

    ``pairs`` names a column for the number of pairs. Pairs of one key, and one
    cell, that are alike in all wanted columns then come as one row with their
    number, instead of that many rows: for a caller who counts them. Every row
    is dealt to its cells all the same; only there are like rows counted, and
    the numbers of both sides multiplied. Rows are alike as ``groupBy`` has it.
    """
    require_columns(a, [*spec.keys_a, *spec.columns_a], "table A")
    require_columns(b, [*spec.keys_b, *spec.columns_b], "table B")
    _require_comparable(a, b, spec)
    names = _output_names(spec)
    if pairs in names:
        raise ValueError(f"the link would return {[pairs]} more than once")
    left, right = _side(a, "A", spec), _side(b, "B", spec)
    on = [TOKEN]
    if split_hot_keys:
        left, right, on = _split_hot_keys(left, right, pairs_per_cell, bool(pairs))
    elif pairs:
        left, right = _counted(left, "rows_a"), _counted(right, "rows_b")
    sides = [f"a{i}" for i in range(len(spec.columns_a))]
    sides += [f"b{i}" for i in range(len(spec.columns_b))]
    joined = left.join(right, on, "inner")
    number = [(F.col("rows_a") * F.col("rows_b")).alias(pairs)] if pairs else []
    return joined.select(*[F.col(c).alias(name) for c, name in zip(sides, names)], *number)
