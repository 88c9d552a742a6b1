"""Near copies of documents by DartMinHash.

A document is a weighted set: its shingles of five words, each as often as it
occurs. Element and occurrence name a region of unit weight. Hashing throws
darts into the regions: each has its own Poisson stream of darts, the same in
every document, and a document sees the darts below a rank that is set so that
about ``k ln k + 2k`` of them are seen, whatever its weight. The earliest dart
on each of ``k`` coordinates is the signature; two documents agree on a
coordinate with a probability that is their weighted Jaccard similarity.

Signatures are joined by bands. Every text is first compared, exactly and on all
its regions, with the most central text of its buckets, the one that most
buckets share most. What is linked by that is one class. Buckets that still
hold several classes are not compared pair by pair: two texts of which at least
``THRESHOLD`` is common must share one of their rarest regions, at a place that
leaves room for the rest. Texts of mixed buckets are joined by these alone, and
only across classes. Copies, of which only the first is compared, get the class
of the text they repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions import free_name, named
from veilframe.llm.arrays import (
    dropped_shuffles,
    if_short,
    joined_utf8,
    mix,
    record_pieces,
    prime_hash,
    repeated_ranges,
    seeded,
    words,
)
from veilframe.sources import materialize, scratch

SHINGLE = 5
BANDS, ROWS = 25, 5
THRESHOLD = 0.8
PIECE = 256 << 10
# Texts are told apart by size in steps of this ratio when their rarest regions are joined.
STEP = 17 / 16


def regions(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The regions of all texts as 64-bit numbers, and how many each text has.

    A text of fewer words than a shingle is one shingle; one without words has
    no region.
    """
    data, starts, _ = joined_utf8(column)
    n = len(starts)
    folded, at, end = words(data)
    spans = prime_hash(23)
    hashes = mix(spans.spans(spans.sums(folded), at, end))
    owner = np.searchsorted(starts, at, side="right") - 1
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    sizes = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    place = repeated_ranges(first, sizes)
    of = np.repeat(np.arange(n), sizes)
    last = (first + count)[of]
    value = np.zeros(len(place), np.uint64)
    for i in range(shingle):
        inside = place + i < last
        value = value * np.uint64(0x9E3779B97F4A7C15)
        value[inside] += hashes[(place + i)[inside]]
    # The occurrences of a shingle in a text are numbered from 0.
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    run = np.flatnonzero(new)
    number = np.arange(len(value)) - np.repeat(run, np.diff(np.append(run, len(value))))
    return mix(value + number.astype(np.uint64) * seeded(3)), sizes


def signatures(region: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Text × coordinate: the earliest dart of each. Texts without a region have zeros."""
    n = len(sizes)
    earliest = np.full((n, k), np.inf)
    dart = np.zeros((n, k), np.uint64)
    todo = np.flatnonzero(sizes > 0)
    firsts = np.cumsum(sizes) - sizes
    expected = k * np.log(k) + 2 * k
    while len(todo):
        limit = expected / sizes[todo]
        of = np.repeat(np.arange(len(todo)), sizes[todo])
        name = region[repeated_ranges(firsts[todo], sizes[todo])]
        rank = np.zeros(len(name))
        throw = 0
        while len(name):
            # The time to the region's next dart is exponential.
            name = mix(name + np.uint64(throw))
            rank = rank - np.log(((name >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))
            seen = rank <= limit[of]
            name, rank, of = name[seen], rank[seen], of[seen]
            _keep_earliest(earliest, dart, todo[of], rank, mix(name ^ seeded(5)), k)
            throw += 1
        # Coordinates that no dart has hit: throw again, to twice the rank.
        todo = todo[np.isinf(earliest[todo]).any(axis=1)]
        expected *= 2
    return dart


def _keep_earliest(earliest, dart, text, rank, name, k: int) -> None:
    flat = text * k + (name % np.uint64(k)).astype(np.int64)
    order = np.lexsort((rank, flat))
    flat, rank, name = flat[order], rank[order], name[order]
    best = np.ones(len(flat), bool)
    best[1:] = flat[1:] != flat[:-1]
    flat, rank, name = flat[best], rank[best], name[best]
    better = rank < earliest.reshape(-1)[flat]
    earliest.reshape(-1)[flat[better]] = rank[better]
    dart.reshape(-1)[flat[better]] = name[better]


def band_keys(dart: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(dart), bands), np.uint64)
    for i in range(rows):
        keys = mix(keys ^ dart[:, i::rows][:, :bands])
    return keys


def _buckets(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(t, buckets)`` of every row whose text has a word; a dart is of one band, and so is a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in record_pieces(batches, "text", PIECE):
            region, sizes = regions(piece.column("text"))
            some = np.flatnonzero(sizes > 0)
            if not len(some):
                continue
            keys = band_keys(signatures(region, sizes, bands * rows)[some], bands, rows)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).reshape(-1)), bands)
            yield pa.record_batch(
                [piece.column("t").take(pa.array(some)), lists.cast(pa.list_(pa.int64()))], ["t", "buckets"]
            )

    return docs.select("t", "text").mapInArrow(run, "t long, buckets array<long>")


def _region_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(t, o, size, regions)`` of the wanted ``(t, o)``; the regions sorted, as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in record_pieces(batches, "text", PIECE):
            region, sizes = regions(piece.column("text"))
            ends = np.cumsum(sizes)
            sets = [np.sort(region[b - s : b]).tobytes() for s, b in zip(sizes, ends)]
            yield pa.record_batch(
                [piece.column("t"), piece.column("o"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())],
                ["t", "o", "size", "regions"],
            )

    chosen = docs.select("t", "text").join(if_short(wanted), "t")
    return chosen.select("t", "o", "text").mapInArrow(run, "t long, o long, size long, regions binary")


def _similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)`` of the pairs ``(a, b, x, y)`` whose region sets' Jaccard similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    continue
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                if both >= threshold * (len(x) + len(y) - both) - 1e-9:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _elements(sets: DataFrame) -> DataFrame:
    """``(t, c, e)``: a row for every region of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("regions")]
            of = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            names = [batch.column(n).take(of) for n in ("t", "c")]
            yield pa.record_batch([*names, pa.array(np.concatenate([*found, np.zeros(0, np.int64)]))], ["t", "c", "e"])

    return sets.select("t", "c", "regions").mapInArrow(run, "t long, c long, e long")


def _step(size: Column) -> Column:
    return F.floor(F.log(size) / float(np.log(STEP)))


def _least_common(a: Column, b: Column, threshold: float) -> Column:
    """How many regions two texts of these sizes must have in common."""
    return F.ceil((a + b) * (threshold / (1 + threshold)) - 1e-9)


def _across_classes(texts: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of texts of different classes that may reach the threshold.

    All that do are among them. ``texts`` is ``(t, c, size, regions)`` with the
    class ``c``, ``sizes`` is ``(c, members)``. The order of regions is the same
    for all texts: those of one class only come first, since they lead to no
    other, then the rarer ones. If ``k`` regions must be common, the first
    common one is behind at most ``size - k`` others in both texts. ``k`` depends
    on both sizes, so regions are joined per pair of steps of sizes. Within
    such a place the members of the largest class are not joined with each other.
    """
    elements = materialize(_elements(texts))
    shared = elements.groupBy("e").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    shared = shared.filter("lo < hi").select("e", "n")
    lists = elements.join(shared, "e").groupBy("t").agg(F.array_sort(F.collect_list(F.struct("n", "e"))).alias("shared"))
    size, t = F.col("size"), threshold
    prefixes = texts.select("t", "c", "size").join(lists, "t").join(sizes, "c")
    steps = F.sequence(_step(F.ceil(size * t)), _step(F.floor(size / t)))
    prefixes = prefixes.withColumn("own", _step(size)).withColumn("other", F.explode(steps))
    least = F.greatest(F.floor(F.pow(F.lit(STEP), F.col("other"))), F.ceil(size * t))
    alone = size - F.size("shared")
    room = (size - _least_common(size, least, t) - alone + 1).cast("int")
    prefixes = prefixes.withColumn("before", alone).filter(room > 0)
    places = prefixes.select(
        "t", "c", "members", "size", "own", "before",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.posexplode(F.slice("shared", 1, room)).alias("i", "region"),
    )
    places = places.withColumn("e", F.col("region.e")).withColumn("place", F.col("before") + F.col("i"))
    places = materialize(places.drop("region", "i", "before"))
    on = ["e", "low", "high"]
    keys = places.groupBy(*on).agg(
        F.min("c").alias("first"), F.max("c").alias("last"), F.max(F.struct("members", "c")).alias("main")
    )
    keys = keys.filter("first < last").select(*on, F.col("main.c").alias("main"))
    mixed = materialize(places.join(keys, on).select(*on, "main", "t", "c", "size", "own", "place"))
    one, two = mixed.filter("c <> main").alias("x"), mixed.alias("y")
    x, y = (lambda n: F.col(f"x.{n}")), (lambda n: F.col(f"y.{n}"))
    fits = (x("c") != y("c")) & (x("own") + y("own") == x("low") + x("high"))
    common = F.least(x("size") - x("place"), y("size") - y("place"))
    fits = fits & (common >= _least_common(x("size"), y("size"), t))
    same = [x(n) == y(n) for n in on]
    met = one.join(two, [*same, fits])
    return met.select(F.least(x("t"), y("t")).alias("a"), F.greatest(x("t"), y("t")).alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """A checksum of a set of edges, to see when it stops changing."""
    key = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(key), F.bit_xor(F.xxhash64(key))).head())


def components(edges: DataFrame) -> DataFrame:
    """``(t, class)``: the smallest member of each connected component, for all ends of edges.

    Alternating star operations on a stored table of edges; each round about
    halves the distance to the smallest member, so few are needed. The loop
    ends when a round changes no edge.
    """
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours beyond a node move to the smallest in its reach.
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: the nearer ones, and the node itself, do the same.
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_low.select("u", F.col("m").alias("v"))
        )
        edges, before = materialize(small.filter("u <> v").distinct()), mark
        mark = _mark(edges)
        if mark == before:
            break
    ends = edges.select(F.col("u").alias("t"), F.col("v").alias("class"))
    return materialize(ends.unionByName(ends.select(F.col("class").alias("t"), "class").distinct()))


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links; ``classes`` as they are if there are none."""
    if links.isEmpty():
        return classes
    return components(links.unionByName(classes.select(F.col("t").alias("a"), F.col("class").alias("b"))))


def near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(key, class)`` for every row of ``docs``.

    ``class`` is the smallest key among the rows whose texts are connected by
    similarities of at least ``threshold``. Rows with equal texts share a
    class, except that every row with a NULL or empty text is a class of its
    own. Texts without words are like their equals only. A NULL key names a
    class only where no row of the class has another key. Other columns are
    not read.

    ``docs`` is read several times and must give the same rows in the same
    order each time, as a stored table does. No pair that shares a bucket is
    left out: each is compared, already in one class, or of too few common
    regions to reach the threshold.
    """
    spark = docs.sparkSession
    with scratch(spark), dropped_shuffles(spark):
        labelled = _groups(docs, key, text, bands, rows, threshold)
        smallest = materialize(labelled.groupBy("group").agg(F.min("key").alias("class")))
        found = materialize(labelled.join(smallest, "group").select(F.col("key").alias(key), "class"), keep=True)
    return found


def deduplicate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row of each class of ``near_copies``: that of the smallest key, and the first of those."""
    spark = docs.sparkSession
    with scratch(spark), dropped_shuffles(spark):
        labelled = _groups(docs, key, text, bands, rows, threshold)
        order = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("t").alias("t"))
        kept = materialize(labelled.groupBy("group").agg(F.min(order).alias("kept")).select(F.col("kept.t").alias("t")))
        gone = materialize(labelled.select("t").join(kept, "t", "left_anti"), keep=True)
    row = free_name("row", docs)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(if_short(gone.withColumnRenamed("t", row)), row, "left_anti").drop(row)


def _groups(
    docs: DataFrame, key: str, text: str, bands: int, rows: int, threshold: float
) -> DataFrame:
    """``(t, key, group)``, stored: each row by its number, and a row that names its class."""
    whole = F.coalesce(named(text).cast("string"), F.lit(""))
    texts = docs.select(
        F.monotonically_increasing_id().alias("t"), named(key).alias("key"), whole.alias("text")
    )
    digest = F.when(F.col("text") != "", F.unhex(F.md5("text"))).alias("digest")
    rows_of = materialize(texts.select("t", "key", digest))
    # The first row of each text stands for its copies.
    firsts = materialize(rows_of.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("t").alias("first")))
    sketches = _buckets(texts, bands, rows).join(firsts.select(F.col("first").alias("t")), "t")
    held = materialize(sketches).select("t", F.explode("buckets").alias("bucket"))
    shared = materialize(held.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    members = materialize(held.join(shared, "bucket"))

    # Each text is compared with the most central one that it meets, itself if it is that.
    weight = members.groupBy("t").agg(F.sum("n").alias("weight"))
    weighted = members.select("t", "bucket").join(weight, "t")
    centre = F.max(F.struct(F.col("weight").alias("weight"), (-F.col("t")).alias("o"))).alias("centre")
    centres = weighted.groupBy("bucket").agg(centre)
    best = members.select("t", "bucket").join(centres, "bucket").groupBy("t").agg(F.max("centre").alias("centre"))
    best = materialize(best.select("t", (-F.col("centre.o")).alias("o")))
    sets = materialize(_region_sets(texts, best))
    hubs = sets.join(best.select(F.col("o").alias("t")).distinct(), "t", "left_semi")
    hubs = hubs.select(F.col("t").alias("o"), F.col("regions").alias("y"))
    near = sets.filter("t <> o").join(hubs, "o")
    near = near.select(F.col("t").alias("a"), F.col("o").alias("b"), F.col("regions").alias("x"), "y")
    classes = components(_similar(near, threshold))

    # Texts of buckets with several classes are compared across them, wherever that can matter.
    mine = classes.select("t", F.col("class").alias("c"))
    classed = members.select("t", "bucket").join(mine, "t", "left").withColumn("c", F.coalesce("c", "t"))
    classed = materialize(classed)
    mixed = classed.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi")
    apart = classed.join(mixed.select("bucket"), "bucket", "left_semi").select("t", "c").distinct()
    apart = materialize(apart)
    if not apart.isEmpty():
        of = materialize(sets.select("t", "size", "regions").join(apart, "t"))
        size = classed.select("t", "c").distinct().groupBy("c").agg(F.count("*").alias("members"))
        pairs = materialize(_across_classes(of, size, threshold))
        for end, into in (("a", "x"), ("b", "y")):
            pairs = pairs.join(of.select(F.col("t").alias(end), F.col("regions").alias(into)), end)
        classes = _joined(classes, materialize(_similar(pairs, threshold)))

    labelled = rows_of.join(firsts, "digest").select("t", "key", "first")
    empty = rows_of.filter("digest IS NULL").select("t", "key", F.col("t").alias("first"))
    labelled = labelled.unionByName(empty).join(classes.withColumnRenamed("t", "first"), "first", "left")
    return materialize(labelled.select("t", "key", F.coalesce("class", "first").alias("group")))
