"""Benchmark decontamination with a positional inverted index of the corpus.

The index is a stored table with one row per shard of documents: for each term
that the benchmark may have, the positions at which the shard has it, in order.
Which terms those are is a table of bits of fixed size; it lets some others in,
so one index serves a benchmark of any size. A phrase is looked up in a shard
by taking the postings of its rarest term, shifting them to where the phrase
would start, and intersecting with the shifted postings of the next rarest term
until all terms are used up. All phrases go through each step together, as
arrays.

Nothing is shuffled but one count per term and shard, and rows of documents.
The benchmark is the stated query set: it is taken in blocks of about
``BLOCK_BYTES`` of text, each made by a task and broadcast.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import named
from veilframe.llm.arrays import (
    gathered,
    joined_utf8,
    packed,
    record_pieces,
    repeated_ranges,
    span_hash,
    unpacked,
    words,
)
from veilframe.sources import materialize, scratch

WIDTH = 13
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 512 << 10
# Bits of the table of the benchmark's terms.
TERM_BITS = 1 << 22
# Positions between the last word of a document and the first of the next.
GAP = 64


class Phrases:
    """The windows of a block of benchmark items as rows of term numbers."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        terms: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            folded, starts, ends = words(np.frombuffer((text or "").encode(), np.uint8))
            data = folded.tobytes()
            found = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            numbers = [terms.setdefault(w, len(terms)) for w in found]
            for i in range(max(len(numbers) - width, 0) + 1 if numbers else 0):
                windows.setdefault(tuple(numbers[i : i + width]), set()).add(item)
        self.terms = terms
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.windows = np.full((len(windows), width), -1, np.int32)
        for i, window in enumerate(windows):
            self.windows[i, : len(window)] = window
        self.items = [_in_order(x) for x in windows.values()]

    def by_rarity(self, counts: np.ndarray) -> np.ndarray:
        """For each window its places, the one with the rarest term first."""
        weight = np.where(self.windows >= 0, counts[self.windows], np.iinfo(np.int64).max)
        return np.argsort(weight, axis=1, kind="stable").astype(np.int8)


def _in_order(items: set[str | None]) -> list[str | None]:
    """Sorted, with NULL last, where Spark's ``array_sort`` has it too."""
    return sorted(items, key=lambda item: (item is None, item or ""))


def _word_hashes(column: pa.Array):
    """The folded bytes of all texts, where each text and word begins, word ends, and hashes of words."""
    data, starts, _ = joined_utf8(column)
    folded, at, ends = words(data)
    spans = span_hash(7)
    return folded, starts, at, ends, spans.spans(spans.sums(folded), at, ends)


def term_table(items: DataFrame) -> np.ndarray:
    """For each remainder of a word's hash whether a word of ``(text)`` has it; small, whatever the items."""
    size = TERM_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in record_pieces(batches, "text", SHARD_BYTES):
            found = np.unique(_word_hashes(piece.column("text"))[4] % np.uint64(size))
            yield pa.record_batch([pa.array(found.astype(np.int32))], ["bit"])

    bits = items.select("text").mapInArrow(run, "bit int").distinct().toArrow().column("bit")
    table = np.zeros(size, bool)
    table[bits.to_numpy()] = True
    return np.packbits(table)


def _same_words(folded, at, size, other) -> np.ndarray:
    """Whether words equal those at the places ``other``, byte by byte."""
    same = size == size[other]
    some = np.flatnonzero(same)
    length = size[some]
    unlike = folded[repeated_ranges(at[some], length)] != folded[repeated_ranges(at[other[some]], length)]
    if len(some):
        same[some] = np.add.reduceat(unlike, np.cumsum(length) - length) == 0
    return same


def _terms(folded: np.ndarray, at: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
    """The number of every word's term, and of every term a word that spells it.

    Words of equal hash are compared with the first of them; those that differ
    are taken up again among themselves.
    """
    size, term = ends - at, np.empty(len(at), np.int64)
    todo, spelled, count = np.argsort(hashes, kind="stable"), [], 0
    while len(todo):
        run = np.flatnonzero(np.diff(hashes[todo], prepend=~hashes[todo[:1]]))
        number = np.repeat(np.arange(len(run)), np.diff(np.append(run, len(todo))))
        chosen = _same_words(folded, at[todo], size[todo], run[number])
        term[todo[chosen]] = count + number[chosen]
        spelled.append(todo[run])
        count += len(run)
        todo = todo[~chosen]
    return term, np.concatenate([np.zeros(0, np.int64), *spelled])


def _shards(batches, table: np.ndarray) -> Iterator[dict]:
    """The postings of each shard, and the word counts of its documents.

    Documents are set apart by a gap, so that no phrase runs from one into the next.
    """
    known = np.unpackbits(table).astype(bool)
    for piece in gathered(batches, "text", SHARD_BYTES):
        if not piece.num_rows:
            continue
        folded, starts, at, ends, hashes = _word_hashes(piece.column("text"))
        owner = np.searchsorted(starts, at, side="right") - 1
        counts = np.bincount(owner, minlength=len(starts))
        place = np.flatnonzero(known[hashes % np.uint64(len(known))])
        term, spelled = _terms(folded, at[place], ends[place], hashes[place])
        data = folded.tobytes()
        order = np.argsort(term, kind="stable")
        position = place + GAP * owner[place]
        yield {
            "rows": piece.column("row"),
            "keys": piece.column("key"),
            "n_words": pa.array(counts.astype(np.int64)),
            "terms": pa.array(
                [data[a:b] for a, b in zip(at[place][spelled].tolist(), ends[place][spelled].tolist())], pa.binary()
            ),
            "counts": pa.array(np.bincount(term, minlength=len(spelled)).astype(np.int32)),
            "positions": packed(position[order].astype(np.uint32)),
        }


def build_index(docs: DataFrame, table: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: a row per shard with ``rows, keys, n_words, terms, counts, positions``.

    ``table`` is a ``term_table``: other words have no postings.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        named(key).alias("key"),
        named(text).cast("string").alias("text"),
    )
    key_type = rows.schema["key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, shared.value):
            positions = shard.pop("positions")
            columns = [
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in shard.values()
            ]
            columns.append(pa.array([positions], pa.binary()))
            yield pa.record_batch(columns, [*shard, "positions"])

    schema = (
        f"rows array<long>, keys array<{key_type}>, n_words array<long>, terms array<binary>, "
        "counts array<int>, positions binary"
    )
    return materialize(rows.mapInArrow(run, schema))


def intersect(
    terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, phrases: Phrases,
    order: np.ndarray, slop: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """``(window, start)`` of every match in a shard.

    With ``slop`` a term may also stand up to that many words off its place,
    measured from the rarest term; this is proximity, exact matches included.
    """
    width = phrases.windows.shape[1]
    windows, order = phrases.windows.astype(np.int64), order.astype(np.int64)
    postings = np.zeros(len(phrases.terms) + 1, np.int64)
    postings[terms + 1] = counts
    postings = np.cumsum(postings)
    number = np.repeat(terms.astype(np.int64), counts)
    keys = (number << 33) + positions
    rows = np.arange(len(windows))
    first = order[:, 0]
    rarest = windows[rows, first]
    size = postings[rarest + 1] - postings[rarest]
    window = np.repeat(rows, size)
    start = positions[repeated_ranges(postings[rarest], size)].astype(np.int64) - first[window]
    for step in range(1, width):
        place = order[window, step]
        term = windows[window, place]
        wanted = (term << 33) + start + place
        at = np.searchsorted(keys, wanted - slop)
        hit = np.zeros(len(window), bool)
        inside = at < len(keys)
        hit[inside] = keys[at[inside]] <= wanted[inside] + slop
        hit |= term < 0
        window, start = window[hit], start[hit]
    return window, start


def find_phrases(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    slop: int = 2,
) -> DataFrame:
    """``(key, n_words, n_hit, items, near_items)`` for every document row.

    Words are runs of ASCII letters and digits and of characters beyond ASCII,
    A-Z in lower case. The phrases are the windows of ``width`` words of the
    items; an item with fewer words is one phrase and an item without words
    none. ``n_hit`` counts the document's words inside any exact occurrence,
    ``items`` are the ids, as text and sorted, of items with an occurrence, and
    ``near_items`` those with a window whose words all stand within ``slop``
    words of their places. Items with a text but a NULL id count like others and
    are together one NULL, the last of ``items`` or ``near_items``.

    NULL and empty texts have no words. Copies and NULL keys keep their rows. An
    empty table of items hits nothing. Other columns of either table are not
    read, whatever their names.
    """
    if width + slop >= GAP:
        raise ValueError(f"width and slop together must stay below {GAP}")
    spark = docs.sparkSession
    with scratch(spark):
        asked = items.select(named(item_key).cast("string").alias("item"), named(item_text).cast("string").alias("text"))
        asked = materialize(asked.filter(F.col("text").isNotNull()))
        size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        blocks = max(-(-size // BLOCK_BYTES), 1)
        index = build_index(docs, term_table(asked), key, text)
        each = F.explode(F.arrays_zip("rows", "keys", "n_words")).alias("d")
        every = index.select(each).select("d.rows", "d.keys", "d.n_words").toDF("row", "key", "n_words")
        every = materialize(every, keep=True)
        counted = F.explode(F.arrays_zip("terms", "counts")).alias("t")
        frequency = index.select(counted).groupBy("t.terms").agg(F.sum("t.counts").alias("n"))
        frequency = materialize(frequency.withColumnRenamed("terms", "term"))
        block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
        hits = [
            materialize(_matches(index, frequency, asked.filter(block == i), width, slop), keep=True)
            for i in range(blocks)
        ]
    found = reduce(DataFrame.unionByName, hits)
    if blocks > 1:
        # Occurrences of different blocks may overlap: their intervals are merged by row.
        joined = lambda name: F.flatten(F.collect_list(name))
        found = found.groupBy("row").agg(
            joined("spans").alias("spans"),
            F.array_sort(F.array_distinct(joined("items"))).alias("items"),
            F.array_sort(F.array_distinct(joined("near_items"))).alias("near_items"),
        )
    found = every.join(found, "row", "left")
    none = F.array().cast("array<string>")
    return found.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce(_covered("spans"), F.lit(0).cast("long")).alias("n_hit"),
        *[F.coalesce(name, none).alias(name) for name in ("items", "near_items")],
    )


def _covered(spans: str):
    """The words under a list of ``(start, end)``, overlaps counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(F.col(spans)),
        zero,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )


def _phrases(block: DataFrame, width: int) -> Phrases:
    """The ``Phrases`` of a block, made by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [
            (item, text)
            for batch in batches
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist())
        ]
        yield pa.record_batch([pa.array([pickle.dumps(Phrases(items, width))], pa.binary())], ["phrases"])

    made = block.select("item", "text").coalesce(1).mapInArrow(run, "phrases binary").head()
    return pickle.loads(bytes(made[0])) if made else Phrases([], width)


def _matches(index: DataFrame, frequency: DataFrame, block: DataFrame, width: int, slop: int) -> DataFrame:
    """``(row, spans, items, near_items)`` of the documents in which a phrase of the block was found."""
    context = index.sparkSession.sparkContext
    phrases = _phrases(block, width)
    shared = context.broadcast(phrases)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = [shared.value.terms.get(t, -1) for t in batch.column("term").to_pylist()]
            mine = pa.array(np.flatnonzero(np.array(number, np.int64) >= 0))
            yield pa.record_batch([pa.array(number, pa.int64()).take(mine), batch.column("n").take(mine)], ["term", "n"])

    counts = np.zeros(len(phrases.terms) + 1, np.int64)
    for row in frequency.mapInArrow(asked, "term long, n long").collect():
        counts[row["term"]] = row["n"]
    order = context.broadcast(phrases.by_rarity(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {c: batch.column(c)[i] for c in batch.schema.names}
                n_words = np.array(shard["n_words"].as_py(), np.int64)
                spans, items, near = _shard_matches(shard, n_words, shared.value, order.value, slop)
                some = [d for d in range(len(n_words)) if items[d] or near[d]]
                yield pa.record_batch(
                    [
                        shard["rows"].values.take(pa.array(some, pa.int64())),
                        pa.array([spans[d] for d in some], SPANS),
                        pa.array([items[d] for d in some], pa.list_(pa.string())),
                        pa.array([near[d] for d in some], pa.list_(pa.string())),
                    ],
                    ["row", "spans", "items", "near_items"],
                )

    return index.drop("keys").mapInArrow(
        run,
        "row long, spans array<struct<start:long,end:long>>, items array<string>, near_items array<string>",
    )


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _shard_matches(shard, n_words: np.ndarray, phrases: Phrases, order: np.ndarray, slop: int):
    """Per document of a shard its matched spans, items and near items."""
    n = len(n_words)
    spans: list[list[dict]] = [[] for _ in range(n)]
    items: list[list[str]] = [[] for _ in range(n)]
    near: list[list[str]] = [[] for _ in range(n)]
    terms = np.array([phrases.terms.get(t, -1) for t in shard["terms"].as_py()], np.int64)
    known = np.argsort(terms, kind="stable")
    known = known[terms[known] >= 0]
    if not len(known) or not len(phrases.windows):
        return spans, items, near
    counts = np.array(shard["counts"].as_py(), np.int64)
    chosen = repeated_ranges((np.cumsum(counts) - counts)[known], counts[known])
    positions = unpacked(shard["positions"].as_py(), np.uint32).astype(np.int64)[chosen]
    terms, counts = terms[known], counts[known]
    firsts = np.cumsum(n_words + GAP) - n_words - GAP
    for found, allowed in ((items, 0), (near, slop)):
        window, start = intersect(terms, counts, positions, phrases, order, allowed)
        owner = np.searchsorted(firsts, start + allowed, side="right") - 1
        sets: dict[int, set] = {}
        for w, d in set(zip(window.tolist(), owner.tolist())):
            sets.setdefault(d, set()).update(phrases.items[w])
        for d, names in sets.items():
            found[d] = _in_order(names)
        if allowed == 0:
            local = start - firsts[owner]
            for w, d, s in zip(window.tolist(), owner.tolist(), local.tolist()):
                spans[d].append({"start": s, "end": s + int(phrases.lengths[w])})
    return spans, items, near
