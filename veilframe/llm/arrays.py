"""Vectorised work on texts inside a task: pieces, spans, words and their hashes.

A task sees its rows as Arrow batches. Operators that work on characters or
bytes take them in pieces of bounded size, so that memory does not depend on
how many rows a batch has. A text is never cut: one that is larger than a piece
is a piece of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions import free_name, named

PIECE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(seed: int) -> np.uint64:
    return mix(np.array([seed], np.uint64))[0]


class SpanHash:
    """Hashes of substrings from one running sum over the symbols.

    Symbol ``j`` counts ``value * base**j`` modulo 2**64, and a span's sum is
    divided by ``base**start``; the base is odd and so has an inverse.
    """

    def __init__(self, seed: int, symbols: int = 256):
        self.base = int(seeded(seed)) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.values = mix(np.arange(symbols, dtype=np.uint64) + seeded(seed + 1))
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) >= n:
            return
        for name, base in (("up", self.base), ("down", self.inverse)):
            powers = np.full(n, base, np.uint64)
            powers[0] = 1
            setattr(self, name, np.multiply.accumulate(powers))

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        total = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(self.values[symbols] * self.up[: len(symbols)], out=total[1:])
        return total

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.down[starts]


@lru_cache(maxsize=None)
def span_hash(seed: int, symbols: int = 256) -> SpanHash:
    return SpanHash(seed, symbols)


PRIME = np.uint64((1 << 61) - 1)
LOW = np.uint64((1 << 31) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _shifted(x: np.ndarray) -> np.ndarray:
    """``x * 2**31`` modulo the prime, by which it turns the 61 bits."""
    return ((x & np.uint64((1 << 30) - 1)) << np.uint64(31)) | (x >> np.uint64(30))


def multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of integers below the prime, modulo the prime, in 64-bit steps."""
    a_low, a_high, b_low, b_high = a & LOW, a >> np.uint64(31), b & LOW, b >> np.uint64(31)
    middle = _reduced(a_high * b_low + a_low * b_high)
    # 2**62 is 2 modulo the prime.
    return _reduced(_reduced(a_low * b_low) + _shifted(middle) + a_high * b_high * np.uint64(2))


class PrimeHash:
    """Hashes of substrings as polynomials modulo the prime ``2**61 - 1``.

    Two strings of ``n`` symbols have the same hash for at most ``n`` of all
    bases; modulo a power of two there are strings that meet for every base.
    """

    def __init__(self, seed: int):
        base = int(seeded(seed)) % int(PRIME - np.uint64(2)) + 2
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, int(PRIME)))
        self.seed, self.values = seeded(seed + 1), np.zeros(0, np.uint64)
        self.up = self.down = np.ones(1, np.uint64)
        self._learn(256)

    def _learn(self, symbols: int) -> None:
        """Values for so many symbols; a table of all code points is made for texts that need it."""
        if len(self.values) < symbols:
            more = np.arange(len(self.values), -(-symbols // 256) * 256, dtype=np.uint64) + self.seed
            self.values = np.concatenate([self.values, mix(more) % (PRIME - np.uint64(1)) + np.uint64(1)])

    def _grow(self, n: int) -> None:
        while len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = getattr(self, name)
                step = multiplied(powers[-1:], base)
                setattr(self, name, np.concatenate([powers, multiplied(powers, step)]))

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        self._learn(int(symbols.max(initial=0)) + 1)
        terms = multiplied(self.values[symbols], self.up[: len(symbols)])
        total = np.zeros(len(symbols) + 1, np.uint64)
        low = _reduced(np.cumsum(terms & LOW, dtype=np.uint64))
        total[1:] = _reduced(low + _shifted(_reduced(np.cumsum(terms >> np.uint64(31), dtype=np.uint64))))
        return total

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return multiplied(_reduced(sums[ends] + PRIME - sums[starts]), self.down[starts])


@lru_cache(maxsize=None)
def prime_hash(seed: int) -> PrimeHash:
    return PrimeHash(seed)


def release() -> None:
    """As ``trim``, and with it the powers of hash bases, which are soon made anew."""
    span_hash.cache_clear()
    prime_hash.cache_clear()
    trim()


def trim() -> None:
    """Give memory that is no longer used back to the system.

    Python workers live on from task to task and from operator to operator, and
    beside them the executor and other workers need it.
    """
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def record_pieces(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``text`` column holds ``limit`` bytes, or one row."""
    try:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
            sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                before = sizes[start - 1] if start else 0
                stop = max(int(np.searchsorted(sizes, before + limit, side="right")), start + 1)
                yield batch.slice(start, stop - start)
                start = stop
    finally:
        release()


# A list of rows up to this length may be sent to every executor; they are two or three numbers each.
SHORT_LIST = 2_000_000


def if_short(df: DataFrame, limit: int = SHORT_LIST) -> DataFrame:
    """A stored table marked for broadcast if it has been counted to be short, else as it is."""
    return F.broadcast(df) if df.count() <= limit else df


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the job that wrote them has stored its result."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def with_columns_of_text(
    docs: DataFrame,
    text: str,
    made: dict[str, str],
    of: Callable[[pa.Array], list[pa.Array]],
    limit: int = PIECE_BYTES,
    without: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with the columns ``made``, name to type, that ``of`` makes of a piece's texts.

    All rows and all other columns stay as they are, whatever their names, but
    for those ``without`` names; columns that have the new names are replaced.
    """
    kept = docs.drop(*made, *without)
    name = free_name("text", kept)
    new = T.StructType.fromDDL(", ".join(f"`{n.replace('`', '``')}` {kind}" for n, kind in made.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in record_pieces(batches, name, limit):
            columns = [piece.column(i) for i in range(piece.num_columns - 1)]
            names = [*piece.schema.names[:-1], *made]
            yield pa.record_batch([*columns, *of(piece.column(name))], names)

    source = docs.select(*map(named, kept.columns), named(text).cast("string").alias(name))
    return source.mapInArrow(run, T.StructType([*kept.schema, *new]))


def gathered(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """As ``record_pieces``, but small slices of several batches become one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in record_pieces(batches, text, limit):
        more = piece.column(text).nbytes
        if held and size + more > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(piece)
        size += more
    if held:
        yield pa.concat_batches(held)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "") -> None:
    """Send texts to tasks in batches of 1,000 rows, and of ``size``, unless the session has chosen.

    Spark's defaults, 10,000 rows and 64 MB, are meant for rows of numbers. A
    batch lies in the executor's direct memory and again in its Python worker.
    """
    chosen = spark.conf.getAll
    if BATCH not in chosen:
        spark.conf.set(BATCH, "1000")
    if size and BATCH_BYTES not in chosen:
        spark.conf.set(BATCH_BYTES, size)


def joined_utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte array with a line feed behind each, and their starts and ends.

    NULL counts as the empty text.
    """
    lengths = pc.fill_null(pc.binary_length(column), 0)
    lengths = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
    data = pc.binary_join(
        pa.array([pc.fill_null(column, "").to_pylist() + [""]], pa.list_(column.type)), "\n"
    )[0].as_buffer()
    ends = np.cumsum(lengths + 1) - 1
    return np.frombuffer(data, np.uint8), ends - lengths, ends


# Word bytes are digits, letters and everything beyond ASCII.
@lru_cache(maxsize=None)
def _folded() -> np.ndarray:
    """Each byte in lower case, and 0 for bytes that separate words."""
    table = np.zeros(256, np.uint8)
    table[128:] = np.arange(128, 256)
    for low, high in ((b"0", b"9"), (b"a", b"z"), (b"A", b"Z")):
        codes = np.arange(low[0], high[0] + 1)
        table[codes] = codes
    table[ord("A") : ord("Z") + 1] += 32
    return table


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Case-folded bytes, and the start and end of every word in them."""
    folded = _folded()[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = folded != 0
    edges = np.diff(inside)
    return folded, np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def repeated_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges ``start .. start + length - 1``, one after the other."""
    total = int(lengths.sum())
    shift = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - shift, lengths)


def packed(values: np.ndarray) -> bytes:
    """An integer array, bytes of equal rank together, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def unpacked(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)
