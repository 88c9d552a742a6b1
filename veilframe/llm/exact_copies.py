"""Exact copies of texts by recipes of content-defined chunks.

A text is cut where its own characters say so: at the first place after
``LEAST`` characters where a punctuation mark and a space stand between certain
letters, or after ``MOST``. Equal texts are cut alike, and long texts that share
passages share chunks, wherever the passages stand. The chunks of all
texts are reduced to distinct ones once, next to their fingerprints; a
fingerprint that stands for one chunk only is that chunk's verified identifier,
and where different chunks share one, the chunk itself is. A text's recipe is
the ordered list of its identifiers, and from then on only recipes are
compared: long documents are moved once, as distinct chunks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions import named
from veilframe.sources import materialize

# Characters of a chunk.
LEAST, MOST = 256, 8192
# Groups with more than this share of all rows are dealt out to several tasks.
SHARES = 1000
# Fixed value: the characters that count as white space.
SPACE = r"[\x20\x09-\x0D]+"


# Where a chunk may end; of the marks followed by a space about every sixteenth.
HALF = "[acegikmoqsuwyACEGIKMOQSUWY02468]"
CUT = rf"{HALF}[.!?;:,]\x20(?={HALF}{HALF}{HALF})"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text in order; together they are the text."""
    pattern = rf"(?s).{{{least - 3},{most - 3}}}?{CUT}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``(key, keep, size, kept, digest)`` for every row of ``docs``.

    Rows are copies if their texts are equal after each run of white space has
    become one space; NULL and empty texts are equal. ``keep`` is the smallest
    key among the copies, ``size`` their number, ``kept`` is true for one of
    them: the row with that key, and the first of those in the table if several
    have it. A NULL key is behind all others, so ``keep`` is NULL only where no
    copy has a key. ``digest`` is the SHA-256 of the text so spaced, in lower-case
    hex. Other columns are not read; an empty table gives no rows.

    ``docs`` is read twice and must give the same rows in the same order each
    time, as a stored table does. Texts may be of any length. ``fingerprint``
    makes a long of a chunk; clashes cost time, never a wrong copy.
    """
    recipes = materialize(_recipes(docs, key, text, fingerprint))
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("row").alias("row"))
    groups = recipes.groupBy("digest", "recipe").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    groups = materialize(groups.filter("size > 1"))
    # Fewer than SHARES groups have more than that share of the rows: a bounded list.
    total = recipes.count()
    pieces = F.ceil(F.col("size") * SHARES / F.lit(max(total, 1))).cast("int")
    hot = groups.filter(F.col("size") * SHARES > total).groupBy("digest").agg(F.max(pieces).alias("pieces"))
    hot = F.broadcast(hot)
    dealt = recipes.join(hot, "digest", "left")
    dealt = dealt.withColumn("piece", F.pmod("row", F.coalesce("pieces", F.lit(1)))).drop("pieces")
    last = F.coalesce("pieces", F.lit(1)).cast("long") - 1
    copied = groups.join(hot, "digest", "left").select(
        "digest", "recipe", "first", "size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    )
    found = dealt.join(copied, ["digest", "recipe", "piece"], "left")
    alone = F.col("size").isNull()
    return found.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("first.key")).alias("keep"),
        F.coalesce("size", F.lit(1)).cast("long").alias("size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("digest"),
    )


def _recipes(docs: DataFrame, key: str, text: str, fingerprint) -> DataFrame:
    """``(row, key, digest, recipe)``; two recipes are equal just where the texts are."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), named(key).alias("key"), normalised(named(text)).alias("text")
    )
    chunks = texts.select("row", F.posexplode(chunks_of(F.col("text"))).alias("place", "chunk"))
    printed = chunks.withColumn("print", fingerprint(F.col("chunk")))
    # Each task sends a chunk once, however many of its texts have it.
    distinct = printed.select("print", "chunk").distinct()
    clashes = materialize(distinct.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    if clashes.isEmpty():
        prints = F.transform(chunks_of(F.col("text")), lambda c: fingerprint(c))
        return texts.select("row", "key", digest, prints.alias("recipe"))
    # Where a fingerprint stands for several chunks, the chunk is its own identifier.
    clashed = printed.join(clashes.withColumn("clash", F.lit(True)), "print", "left")
    part = F.struct("place", "print", F.when(F.col("clash"), F.col("chunk")).alias("chunk"))
    lists = clashed.groupBy("row").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    recipe = F.transform("parts", lambda p: F.struct(p["print"], F.coalesce(p["chunk"], F.lit("")).alias("chunk")))
    lists = lists.select("row", recipe.alias("recipe"))
    found = texts.select("row", "key", digest).join(lists, "row", "left")
    none = F.array().cast(lists.schema["recipe"].dataType)
    return found.withColumn("recipe", F.coalesce("recipe", none))
