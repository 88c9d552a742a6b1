"""Removal of long strings that repeat across documents.

Which strings of ``length`` bytes start in more than one document is a question
about neighbours in the corpus's suffix array, asked to a fixed depth. The
array is never held as a whole; it is built one bucket of suffixes at a time.

First a difference cover picks about a quarter of all positions: however two
equal strings lie, a common offset below the cover's period leads to a picked
position in both. The strings at picked positions are given ranks, bucket by
bucket, and a suffix can have an equal only if a picked position near its start
ties with another document. All other suffixes drop out before any sorting.

Then, one bucket after the other, the remaining suffixes are sorted and runs
of equals that hold more than one document are reported to where they start.
What is shuffled at a time is a bucket's share of the suffixes; a string that a
shard holds many times has one entry. Ranks are 64-bit hashes of the strings
rather than places in their alphabetical order: only equality matters here.
Suffixes are compared on 96 bits.

Texts that repeat an earlier one as a whole are told by their SHA-256 before
all that: every string of theirs starts in the earlier text as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import named
from veilframe.llm.arrays import (
    dropped_shuffles,
    gathered,
    if_short,
    joined_utf8,
    mix,
    packed,
    repeated_ranges,
    span_hash,
    unpacked,
)
from veilframe.sources import materialize, scratch

LENGTH = 50
SHARD_BYTES = 2 << 20
COVER_BITS, SUFFIX_BITS = 1, 2  # 2 and 4 buckets
# Bytes of text whose entries of a bucket meet in one group.
GROUP_BYTES = 16 << 20

# Difference covers by period; every difference occurs in each.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}


class Shard:
    """Texts back to back; documents without a key take no part."""

    def __init__(self, row: dict):
        self.data = np.frombuffer(zstandard.decompress(row["data"]), np.uint8)
        self.lengths = np.array(row["lengths"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.known = np.array([k is not None for k in row["keys"]], bool)
        self.keys = np.array([k or 0 for k in row["keys"]], np.int64)

    def suffixes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Every position with ``length`` bytes to its text's end, and the text's number."""
        sizes = np.where(self.known, np.maximum(self.lengths - length + 1, 0), 0)
        return repeated_ranges(self.starts, sizes), np.repeat(np.arange(len(sizes)), sizes)


def _range_of(ranks: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """An even division of the ranks of one bucket, in their order."""
    rest = (ranks << np.uint64(bits)) >> np.uint64(32)
    return ((rest * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _ranks(data: np.ndarray, positions: np.ndarray, length: int, seed: int = 41) -> np.ndarray:
    spans = span_hash(seed)
    return mix(spans.spans(spans.sums(data), positions, positions + length))


def _of_bucket(ranks: np.ndarray, bucket: int, bits: int) -> np.ndarray:
    return np.flatnonzero(ranks >> np.uint64(64 - bits) == np.uint64(bucket))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in sorted columns."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _cover(length: int) -> tuple[int, tuple[int, ...]]:
    period = max(p for p in COVERS if p <= max(length // 2, 1))
    return period, COVERS[period]


def _sorted_runs(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pairs together, and where their runs begin."""
    order = np.argsort(key)
    run = _runs(key[order])
    if len(run) < len(key) and len(_runs(key[order], check[order])) != len(run):
        order = np.lexsort((check, key))
        run = _runs(key[order], check[order])
    return order, run


def _picked(shard: Shard, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Picked positions, their texts' numbers and the ranks of the strings there."""
    period, places = _cover(length)
    size = length - period + 1
    # Positions that a text of that length has, one of the cover's places after the other.
    sizes = np.where(shard.known, np.maximum(shard.lengths - size + 1, 0), 0)
    at, owner = [], []
    for place in places:
        counts = np.maximum(sizes - place + period - 1, 0) // period
        of = np.repeat(np.arange(len(sizes)), counts)
        number = repeated_ranges(np.zeros(len(sizes), np.int64), counts)
        at.append(shard.starts[of] + place + period * number)
        owner.append(of)
    at, owner = np.concatenate(at), np.concatenate(owner)
    return at, owner, _ranks(shard.data, at, size)


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _pieces(ranges: int, of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The ranges that sorted entries fall into, and their slices."""
    cuts = np.searchsorted(of, np.arange(ranges + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        yield i, slice(int(cuts[i]), int(cuts[i + 1]))


def _batch(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of a part, a shard and binary columns."""
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * (len(names) - 2)
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)


def _whole_copies(rows: DataFrame, length: int) -> DataFrame:
    """``(t)``, stored: the rows whose text a row with a smaller key has too."""
    long = F.col("key").isNotNull() & (F.octet_length("text") >= length)
    heads = rows.filter(long).select("t", "key", F.unhex(F.sha2("text", 256)).alias("digest"))
    heads = materialize(heads)
    least = heads.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    least = materialize(least.filter("first < last").select("digest", "first"))
    return materialize(heads.join(least, "digest").filter("key > first").select("t"), keep=True)


def _stored_shards(rows: DataFrame) -> DataFrame:
    rows = rows.select("key", "text", F.spark_partition_id().alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, piece in enumerate(gathered(batches, "text", SHARD_BYTES)):
            if not piece.num_rows:
                continue
            data, starts, ends = joined_utf8(piece.column("text"))
            inside = np.ones(len(data), bool)
            inside[ends] = False
            shard = (piece.column("task")[0].as_py() << 32) + number
            yield pa.record_batch(
                [
                    pa.array([shard], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column("key")),
                    pa.array([(ends - starts).tolist()], pa.list_(pa.int64())),
                    pa.array([zstandard.compress(data[inside].tobytes(), 3)], pa.binary()),
                ],
                ["shard", "keys", "lengths", "data"],
            )

    schema = "shard long, keys array<long>, lengths array<long>, data binary"
    return materialize(rows.mapInArrow(run, schema), keep=True)


def _tied_ranks(shards: DataFrame, length: int, bucket: int, ranges: int) -> DataFrame:
    """``(shard, ranks)``: the cover ranks of a bucket that more than one text has."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = Shard(row)
            _, owner, ranks = _picked(shard, length)
            chosen = _of_bucket(ranks, bucket, COVER_BITS)
            ranks, texts = ranks[chosen], shard.keys[owner[chosen]]
            order = np.argsort(ranks)
            ranks, texts = ranks[order], texts[order]
            run = _runs(ranks)
            if not len(run):
                continue
            several = np.maximum.reduceat(texts, run) != np.minimum.reduceat(texts, run)
            ranks = ranks[run]
            found = [
                (i, row["shard"], packed(ranks[s]), np.packbits(several[s]).tobytes())
                for i, s in _pieces(ranges, _range_of(ranks, COVER_BITS, ranges))
            ]
            yield _batch(found, ["part", "shard", "ranks", "several"])

    def tied(group: pa.Table) -> pa.Table:
        lists = [unpacked(x, np.uint64) for x in group.column("ranks").to_pylist()]
        several = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(ranks)).astype(bool)
            for x, ranks in zip(group.column("several").to_pylist(), lists)
        ]
        every = np.concatenate(lists)
        order = np.argsort(every)
        run = _runs(every[order])
        many = np.diff(np.append(run, len(every))) > 1
        many |= np.logical_or.reduceat(np.concatenate(several)[order], run)
        known = every[order][run[many]]
        shards_, found = [], []
        for shard, ranks in zip(group.column("shard").to_pylist(), lists):
            at = np.searchsorted(known, ranks)
            mine = ranks[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == ranks)] if len(known) else known
            if len(mine):
                shards_.append(shard)
                found.append(packed(mine))
        return pa.table({"shard": pa.array(shards_, pa.int64()), "ranks": pa.array(found, pa.binary())})

    lists = shards.mapInArrow(ranked, "part int, shard long, ranks binary, several binary")
    return materialize(lists.groupBy("part").applyInArrow(tied, "shard long, ranks binary"))


def _in_play(shards: DataFrame, tied: DataFrame, length: int) -> DataFrame:
    """The stretches of each shard in which a suffix may have an equal, with their bytes."""
    period, _ = _cover(length)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            shard = Shard(row)
            known = np.sort(np.concatenate([unpacked(x, np.uint64) for x in right.column("ranks").to_pylist()]))
            at, _, ranks = _picked(shard, length)
            place = np.minimum(np.searchsorted(known, ranks), len(known) - 1)
            at = at[known[place] == ranks]
            near = np.zeros(len(shard.data) + 1, np.int32)
            near += np.bincount(np.maximum(at - period + 1, 0), minlength=len(near)).astype(np.int32)
            near -= np.bincount(at + 1, minlength=len(near)).astype(np.int32)
            position, owner = shard.suffixes(length)
            kept = np.cumsum(near)[position] > 0
            position, owner = position[kept], owner[kept]
            if len(position):
                new = np.ones(len(position), bool)
                new[1:] = (np.diff(position) != 1) | (np.diff(owner) != 0)
                begin = np.flatnonzero(new)
                count = np.diff(np.append(begin, len(position)))
                places = repeated_ranges(position[begin], count + length - 1)
                found.append(
                    (
                        row["shard"],
                        packed(position[begin].astype(np.uint32)),
                        packed((count + length - 1).astype(np.uint32)),
                        packed(shard.keys[owner[begin]]),
                        zstandard.compress(shard.data[places].tobytes(), 3),
                    )
                )
        columns = list(zip(*found)) or [(), (), (), (), ()]
        kinds = [pa.int64()] + [pa.binary()] * 4
        names = ["shard", "starts", "sizes", "texts", "data"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    joined = shards.groupBy("shard").cogroup(tied.groupBy("shard"))
    return materialize(
        joined.applyInArrow(run, "shard long, starts binary, sizes binary, texts binary, data binary")
    )


def _entries(key: np.ndarray, check: np.ndarray, text: np.ndarray, position: np.ndarray):
    """One entry per distinct string, and the positions of it that need no further comparison.

    An entry has the smallest key with the string, a place there, and whether
    there are more places of that key. Places of other keys are behind it.
    """
    order, run = _sorted_runs(key, check)
    size = np.diff(np.append(run, len(key)))
    text, position = text[order], position[order]
    later = text > np.repeat(np.minimum.reduceat(text, run), size)
    place = np.where(later, np.iinfo(np.int64).max, position)
    more = np.add.reduceat(~later, run) > 1
    first = order[run]
    low = np.minimum.reduceat(text, run)
    return key[first], check[first], low, np.minimum.reduceat(place, run), more, np.sort(position[later])


def _differences(positions: np.ndarray) -> bytes:
    """Ascending places below 2**32."""
    return packed(np.diff(positions.astype(np.uint32), prepend=np.uint32(0)).astype(np.uint32))


def _places(data: list[bytes]) -> np.ndarray:
    found = [np.cumsum(unpacked(x, np.uint32), dtype=np.int64) for x in data]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _later_starts(stretches: DataFrame, length: int, bucket: int, ranges: int) -> DataFrame:
    """``(shard, positions, more)`` of a bucket's suffixes that an earlier text has too.

    ``more`` are those of the positions whose key has the same string elsewhere.
    """

    def sorted_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            data = np.frombuffer(zstandard.decompress(row["data"]), np.uint8)
            sizes = unpacked(row["sizes"], np.uint32).astype(np.int64)
            starts = unpacked(row["starts"], np.uint32).astype(np.int64)
            texts = unpacked(row["texts"], np.int64)
            first, count = np.cumsum(sizes) - sizes, sizes - length + 1
            at = repeated_ranges(first, count)
            key = _ranks(data, at, length)
            chosen = _of_bucket(key, bucket, SUFFIX_BITS)
            if not len(chosen):
                continue
            stretch = np.repeat(np.arange(len(sizes)), count)[chosen]
            check = _ranks(data, at[chosen], length, 43).astype(np.uint32)
            position = at[chosen] - first[stretch] + starts[stretch]
            key, check, text, position, more, behind = _entries(key[chosen], check, texts[stretch], position)
            found = [
                (
                    i, row["shard"], packed(key[s]), packed(check[s]), packed(text[s]),
                    packed(position[s].astype(np.uint32)), np.packbits(more[s]).tobytes(), _differences(behind[:0]),
                )
                for i, s in _pieces(ranges, _range_of(key, SUFFIX_BITS, ranges))
            ]
            found[0] = (*found[0][:-1], _differences(behind))
            yield _batch(found, ["part", "shard", "keys", "checks", "texts", "positions", "more", "behind"])

    def equal(group: pa.Table) -> pa.Table:
        read = lambda c, kind: [unpacked(x, kind) for x in group.column(c).to_pylist()]
        lists = read("keys", np.uint64)
        key, check = np.concatenate(lists), np.concatenate(read("checks", np.uint32))
        text = np.concatenate(read("texts", np.int64))
        order, run = _sorted_runs(key, check)
        first = np.minimum.reduceat(text[order], run)
        later = np.zeros(len(key), bool)
        later[order] = text[order] > np.repeat(first, np.diff(np.append(run, len(key))))
        found, at = [], 0
        columns = [group.column(c).to_pylist() for c in ("shard", "more", "behind")]
        for shard, several, behind, positions in zip(*columns, read("positions", np.uint32)):
            mine = later[at : at + len(positions)]
            at += len(positions)
            several = np.unpackbits(np.frombuffer(several, np.uint8), count=len(positions)).astype(bool)
            places = np.sort(np.concatenate([positions[mine].astype(np.int64), _places([behind])]))
            if len(places):
                found.append((shard, _differences(places), _differences(np.sort(positions[mine & several]))))
        names, kinds = ["shard", "positions", "more"], [pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*found)) or [()] * 3
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    lists = stretches.mapInArrow(
        sorted_suffixes,
        "part int, shard long, keys binary, checks binary, texts binary, positions binary, more binary, behind binary",
    )
    schema = "shard long, positions binary, more binary"
    return materialize(lists.groupBy("part").applyInArrow(equal, schema), keep=True)


def _removed(shard: Shard, later: np.ndarray, more: np.ndarray, length: int) -> np.ndarray:
    """For each byte whether a string that an earlier text has covers it."""
    if len(more):
        later = np.concatenate([later, _same_in_texts(shard, more, length)])
    size = len(shard.data) + 1
    edges = np.bincount(later, minlength=size) - np.bincount(later + length, minlength=size)
    return np.cumsum(edges)[:-1] > 0


def _same_in_texts(shard: Shard, places: np.ndarray, length: int) -> np.ndarray:
    """Where the strings at these places stand in the texts of the same keys."""
    of = shard.keys[np.searchsorted(shard.starts, places, side="right") - 1]
    texts = np.flatnonzero(shard.known & (shard.lengths >= length) & np.isin(shard.keys, of))
    count = shard.lengths[texts] - length + 1
    position, owner = repeated_ranges(shard.starts[texts], count), np.repeat(shard.keys[texts], count)
    pairs = []
    for seed in (41, 43):
        pairs.append([_ranks(shard.data, at, length, seed) for at in (position, places)])
    # A string of a key is known by both hashes.
    both = [np.stack([key.view(np.uint64), *(p[i] for p in pairs)]) for i, key in ((0, owner), (1, of))]
    every = np.concatenate(both, axis=1)
    order = np.lexsort(every)
    ordered = every[:, order]
    run = _runs(*ordered)
    wanted = np.zeros(len(order), bool)
    wanted[len(position) :] = True
    chosen = np.logical_or.reduceat(wanted[order], run)
    same = order[np.repeat(chosen, np.diff(np.append(run, len(order))))]
    return position[same[same < len(position)]]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``(key, n_bytes, removed, kept)`` for every row of ``docs``.

    Texts are their UTF-8 bytes. ``removed`` holds the ``(start, end)`` of the
    maximal runs of bytes that are covered by a string of ``length`` bytes which
    also starts in a row with a smaller key; ``kept`` the other bytes, which
    may cut a character. Rows with equal keys are no earlier than each other.
    A NULL text counts as empty; a row with a NULL key keeps all and takes
    nothing from others. Keys are integers. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("t"),
        named(key).cast("long").alias("key"),
        F.coalesce(named(text).cast("string"), F.lit("")).alias("text"),
    )
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    with scratch(spark), dropped_shuffles(spark):
        copies = if_short(_whole_copies(rows, length))
        shards = _stored_shards(rows.join(copies, "t", "left_anti"))
        size = F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x)
        total = shards.select(F.sum(size)).first()[0] or 0
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_BYTES))
        tied = union([_tied_ranks(shards, length, b, ranges) for b in range(1 << COVER_BITS)])
        stretches = _in_play(shards, tied, length)
        later = union([_later_starts(stretches, length, b, ranges) for b in range(1 << SUFFIX_BITS)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        shard = Shard(row)
        places = [_places(right.column(c).to_pylist()) for c in ("positions", "more")]
        removed = _removed(shard, *places, length)
        spans, kept = [], []
        for start, size in zip(shard.starts.tolist(), shard.lengths.tolist()):
            mine = removed[start : start + size]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
            spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            kept.append(shard.data[start : start + size][~mine].tobytes())
        return pa.table(
            {
                "key": left.column("keys").combine_chunks().flatten(),
                "n_bytes": pa.array(shard.lengths),
                "removed": pa.array(spans, SPANS),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    found = shards.groupBy("shard").cogroup(later.groupBy("shard")).applyInArrow(
        run, "key long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    )
    size = F.octet_length("text").cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
    repeated = rows.join(copies, "t", "left_semi").select(
        "key", size.alias("n_bytes"), whole.alias("removed"), F.lit(b"").alias("kept")
    )
    return found.unionByName(repeated).withColumnRenamed("key", key)
