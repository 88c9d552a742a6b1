"""Byte-pair encoding of whole texts through a table of distinct words.

Texts are cut into words by the tokenizer's own rule and a block of them is
written as numbers into the block's list of distinct words. The lists of all
blocks meet, divided by a hash of the word, so that each distinct word of the
corpus is encoded exactly once. The ids go back to the blocks, where they are
joined to the words' positions, and the ids to the pieces of the vocabulary
for decoding. What is shuffled is one entry per block and distinct word, never
one per position, and a word that is everywhere has one entry per block.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veilframe.functions import named
from veilframe.llm.arrays import packed, prime_hash, record_pieces, repeated_ranges, trim, unpacked
from veilframe.sources.tables import estimated_bytes, straight_from_files

BLOCK_BYTES = 4 << 20
# Texts are cut into words and hashed in pieces of so many bytes, or one text.
PIECE = 64 << 10
# Code points of decoded texts, or one text, that a result goes out with.
OUT_PIECE = 256 << 10
# Bytes of texts, or of the files that hold them, whose distinct words are encoded by one group.
GROUP_BYTES = 32 << 20
ENCODE_BATCH = 1_000
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
# Endings that the word rule cuts off behind an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class CharacterKinds:
    """Letter, number, other or space for code points, as the tokenizer's rule has it.

    Its Unicode tables may differ from Python's, so it is asked about each
    character that turns up: one sticks to a character before it of its own
    kind, and a space to none.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.rule = tokenizer.pre_tokenizer
        self.table = np.full(0x110000, UNKNOWN, np.uint8)

    def __getitem__(self, points: np.ndarray) -> np.ndarray:
        kinds = self.table[points]
        if (kinds == UNKNOWN).any():
            for point in np.unique(points[kinds == UNKNOWN]).tolist():
                self.table[point] = self._ask(chr(point))
            kinds = self.table[points]
        return kinds

    def _ask(self, character: str) -> int:
        for kind, first in ((LETTER, "x"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.rule.pre_tokenize_str(first + character)) == 1:
                return kind
        return SPACE


def _rule(tokenizer_json: str) -> str:
    """The tokenizer without its vocabulary: the rule by which it cuts words."""
    whole = json.loads(tokenizer_json)
    return json.dumps(whole | {"added_tokens": [], "model": whole["model"] | {"vocab": {}, "merges": []}})


@lru_cache(maxsize=2)
def _tokenizer(tokenizer_json: str) -> tuple[Tokenizer, CharacterKinds]:
    tokenizer = Tokenizer.from_str(tokenizer_json)
    return tokenizer, CharacterKinds(tokenizer)


def word_starts(points: np.ndarray, kinds: CharacterKinds) -> np.ndarray:
    """Where the words of a text start; the words cover it without gaps.

    A word is a run of letters, of numbers or of other symbols, with one blank
    before it if there is one; a run of white space leaves its last character
    to the next word; an apostrophe that begins a word takes an ending along.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = kinds[points]
    starts = np.ones(n, bool)
    starts[1:] = kind[1:] != kind[:-1]
    is_space = kind == SPACE
    # The last character of a white-space run before a word stands alone ...
    last_space = np.flatnonzero(is_space[:-1] & ~is_space[1:])
    starts[last_space] = True
    # ... and if it is a blank, the word begins with it.
    blank = last_space[points[last_space] == 32]
    starts[blank + 1] = False
    quotes = np.flatnonzero((points == 39) & starts)
    for i in quotes.tolist():
        following = "".join(map(chr, points[i + 1 : i + 3].tolist()))
        for ending in ENDINGS:
            if following.startswith(ending):
                starts[i + 1] = False
                if i + 1 + len(ending) < n:
                    starts[i + 1 + len(ending)] = True
                break
    return np.flatnonzero(starts)


class Words:
    """The distinct words of a block and its texts as numbers into them."""

    def __init__(self, kinds: CharacterKinds, special: dict[str, int]):
        self.kinds, self.special = kinds, special
        self.hashes, self.firsts, self.codes, self.texts, self.bounds = [], [], [], [], []
        self.counts: list[int] = []
        self.checks: list[int] = []
        self.keys: list[pa.Array] = []
        self.size = 0

    def _parts(self, text: str) -> list[str]:
        """The text cut at special tokens, which are words of their own."""
        parts = [text]
        for token in self.special:
            if token in text:
                cut = []
                for part in parts:
                    if part in self.special:
                        cut.append(part)
                        continue
                    for i, rest in enumerate(part.split(token)):
                        cut += [token, rest] if i else [rest]
                parts = cut
        return [part for part in parts if part]

    def add(self, keys: pa.Array, texts: list[str | None]) -> None:
        """A piece of rows; one running hash over all of them."""
        parts, owners = [], []
        for i, text in enumerate(texts):
            text = text or ""
            self.checks.append(zlib.crc32(text.encode()))
            if any(token in text for token in self.special):
                found = self._parts(text)
            else:
                found = [text] if text else []
            parts += found
            owners += [i] * len(found)
            self.size += len(text)
        # A copy, as a slice would hold the texts of its batch.
        self.keys.append(keys.take(pa.array(range(len(keys)), pa.int32())))
        counts = np.zeros(len(texts), np.int64)
        if not parts:
            self.counts += counts.tolist()
            return
        joined = "".join(parts)
        points = _code_points(joined)
        starts, at = [], 0
        for part, owner in zip(parts, owners):
            if part in self.special:
                found = np.zeros(1, np.int64)
            else:
                found = word_starts(points[at : at + len(part)], self.kinds)
            starts.append(found + at)
            counts[owner] += len(found)
            at += len(part)
        starts = np.concatenate(starts)
        bounds = np.append(starts, at)
        spans = prime_hash(2)
        found = spans.spans(spans.sums(points), starts, bounds[1:])
        # The words of a piece are made distinct at once, so that a block never holds a hash per position.
        distinct, first, codes = np.unique(found, return_index=True, return_inverse=True)
        self.hashes.append(distinct)
        self.firsts.append(first.astype(np.uint32))
        self.codes.append(codes.astype(np.uint32))
        self.bounds.append(bounds.astype(np.uint32))
        self.texts.append(joined)
        self.counts += counts.tolist()

    def finish(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, their hashes, and the number of the word at every position.

        Words of equal hash are compared; one that differs from the first with
        its hash is a word of its own. Nothing but the keys, counts and checks
        of the texts is kept.
        """
        if not self.hashes:
            return [], np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        before = np.cumsum([0, *map(len, self.hashes)])
        distinct, first, which = np.unique(
            np.concatenate(self.hashes), return_index=True, return_inverse=True
        )
        which = which.astype(np.uint32)
        piece = np.searchsorted(before, first, side="right") - 1
        found = []
        for i, at in zip(piece.tolist(), np.concatenate(self.firsts)[first].tolist()):
            a, b = self.bounds[i][at : at + 2].tolist()
            found.append(self.texts[i][a:b])
        spelled = _code_points("".join(found))
        size = np.array([len(w) for w in found], np.int64)
        start, others = np.cumsum(size) - size, {}
        codes, at = np.empty(sum(map(len, self.codes)), np.uint32), 0
        for i, text in enumerate(self.texts):
            mine = codes[at : at + len(self.codes[i])]
            mine[:] = which[before[i] : before[i + 1]][self.codes[i]]
            at += len(mine)
            bounds = self.bounds[i].astype(np.int64)
            for j in _unlike(_code_points(text), bounds, spelled, start[mine], size[mine]).tolist():
                number = others.setdefault(text[bounds[j] : bounds[j + 1]], len(found) + len(others))
                distinct = np.append(distinct, distinct[mine[j]]) if number == len(distinct) else distinct
                mine[j] = number
            self.codes[i] = self.bounds[i] = self.texts[i] = None
        for held in (self.hashes, self.firsts, self.codes, self.bounds, self.texts):
            held.clear()
        return found + list(others), distinct, codes


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _unlike(points, bounds, spelled, start, size) -> np.ndarray:
    """Which of the words between ``bounds`` are not the spelled words they are taken for."""
    length = np.diff(bounds)
    unlike = length != size
    same = np.flatnonzero(~unlike)
    # The words cover the text, so the places of all of them are a range.
    whole = len(same) == len(length)
    own = points[bounds[0] : bounds[-1]] if whole else points[repeated_ranges(bounds[:-1][same], length[same])]
    differs = own != spelled[repeated_ranges(start[same], length[same])]
    if differs.any():
        unlike[same[np.add.reduceat(differs, np.cumsum(length[same]) - length[same]) > 0]] = True
    return np.flatnonzero(unlike)


def _special(tokenizer_json: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in json.loads(tokenizer_json)["added_tokens"]}


def _blocks(batches, key: str, text: str, rule: str, special: dict[str, int], partition: int):
    """``(block id, Words)`` for every block of a task's rows."""
    kinds = _tokenizer(rule)[1]
    block, number = Words(kinds, special), 0
    for piece in record_pieces(batches, text, PIECE):
        if block.size and block.size + piece.nbytes > BLOCK_BYTES:
            yield (partition << 32) + number, block
            block, number = Words(kinds, special), number + 1
            trim()
        block.add(piece.column(key), piece.column(text).to_pylist())
    if block.keys:
        yield (partition << 32) + number, block


def pieces_of(tokenizer_json: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary; its size is the bound."""
    model = json.loads(tokenizer_json)["model"]["vocab"]
    symbols = _byte_symbols()
    table = [b""] * (max([*model.values(), *_special(tokenizer_json).values()]) + 1)
    for piece, i in model.items():
        table[i] = bytes(symbols[c] for c in piece)
    for piece, i in _special(tokenizer_json).items():
        table[i] = piece.encode()
    return table


def _byte_symbols() -> dict[str, int]:
    """The printable symbol that a byte-level vocabulary writes for each byte.

    Bytes that print stand for themselves, the others for 256, 257 and so on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def encode_decode(
    docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, ids, decoded)`` for every row, copies and NULL keys included.

    ``ids`` are little-endian unsigned 32-bit integers. A NULL text counts as
    empty and an empty text has no ids. Only ``key`` and ``text`` of ``docs``
    are read, whatever else it holds. ``docs`` is read twice and must give the
    same rows in the same order both times, as a stored table does; blocks
    carry a checksum of their texts, and a difference is an error, as is a
    text that its own ids do not decode to.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer_json = file.read()
    rule, special = _rule(tokenizer_json), _special(tokenizer_json)
    shared = spark.sparkContext.broadcast((tokenizer_json, _Pieces(pieces_of(tokenizer_json))))
    rows = docs.select(named(key).alias("key"), named(text).cast("string").alias("text"))
    # The number of groups follows the input; results do not depend on it.
    if straight_from_files(rows):
        size = estimated_bytes(rows)
    else:
        size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))
    key_type = rows.schema["key"].dataType.simpleString()
    rows = rows.withColumn("task", F.spark_partition_id())

    def blocks(batches):
        first = next(batches, None)
        if first is None or first.num_rows == 0:
            return
        yield from _blocks(
            chain([first], batches), "key", "text", rule, special, first.column("task")[0].as_py()
        )

    # What is made of a block is local to a call, so that it is gone when the next block is read.
    def word_list(block: int, content: Words) -> pa.RecordBatch:
        found, hashes, _ = content.finish()
        part = (hashes % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(ranges + 1))
        some, data = np.flatnonzero(np.diff(cuts)).tolist(), []
        for i in some:
            chosen = order[cuts[i] : cuts[i + 1]].tolist()
            data.append(_packed_words([found[j] for j in chosen]))
        return pa.record_batch(
            [
                pa.array(some, pa.int32()),
                pa.array([block] * len(some), pa.int64()),
                pa.array(data, pa.binary()),
            ],
            ["part", "block", "words"],
        )

    def word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, content in blocks(batches):
            yield word_list(block, content)

    def encoded(group: pa.Table) -> pa.Table:
        tokenizer = _tokenizer(shared.value[0])[0]
        # Arrow holds the words of all lists; as Python's strings they would take ten times the room.
        lists = [_unpacked_words(data) for data in group.column("words").to_pylist()]
        ends = np.cumsum([0, *map(len, lists)]).tolist()
        words = pa.concat_arrays([pa.array([], pa.large_string()), *lists]).dictionary_encode()
        distinct, numbers = words.dictionary, words.indices.to_numpy()
        del lists, words
        counts, ids = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for i in range(0, len(distinct), ENCODE_BATCH):
            some = distinct.slice(i, ENCODE_BATCH).to_pylist()
            # One by one: a batch starts threads, each with a cache and memory that are never given back.
            own = [tokenizer.encode(word, add_special_tokens=False).ids for word in some]
            counts.append(np.array([*map(len, own)], np.uint32))
            ids.append(np.fromiter(chain.from_iterable(own), np.uint32))
        counts, flat = np.concatenate(counts), np.concatenate(ids)
        firsts = np.cumsum(counts, dtype=np.int64) - counts
        lengths, values = [], []
        for a, b in zip(ends, ends[1:]):
            chosen = numbers[a:b]
            lengths.append(packed(counts[chosen]))
            places = repeated_ranges(firsts[chosen], counts[chosen].astype(np.int64))
            values.append(packed(flat[places]))
        trim()
        return pa.table(
            {
                "part": group.column("part"),
                "block": group.column("block"),
                "lengths": pa.array(lengths, pa.binary()),
                "ids": pa.array(values, pa.binary()),
            }
        )

    def coded_block(block: int, content: Words) -> pa.RecordBatch:
        _, hashes, codes = content.finish()
        return pa.record_batch(
            [
                pa.array([block], pa.int64()),
                _one_list(pa.concat_arrays(content.keys)),
                pa.array([content.counts], pa.list_(pa.int64())),
                pa.array([content.checks], pa.list_(pa.int64())),
                pa.array([packed((hashes % np.uint64(ranges)).astype(np.uint32))], pa.binary()),
                pa.array([packed(codes)], pa.binary()),
            ],
            ["block", "keys", "counts", "checks", "parts", "codes"],
        )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, content in blocks(batches):
            yield coded_block(block, content)

    def assembled(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise ValueError("two readings of the texts gave different blocks; store them first")
        row = left.select(["counts", "checks", "parts", "codes"]).to_pylist()[0]
        right = right.sort_by("part")
        parts, none = unpacked(row["parts"], np.uint32), np.zeros(0, np.uint32)
        if right.column("part").to_pylist() != np.unique(parts).tolist():
            raise ValueError("two readings of the texts gave different words; store them first")
        by_part = [none, *(unpacked(x, np.uint32) for x in right.column("lengths").to_pylist())]
        by_part = np.concatenate(by_part).astype(np.int64)
        ids = np.concatenate([none, *(unpacked(x, np.uint32) for x in right.column("ids").to_pylist())])
        # The words of a part come in the order of their numbers.
        order = np.argsort(parts, kind="stable")
        if len(order) != len(by_part):
            raise ValueError("two readings of the texts gave different words; store them first")
        first = np.empty(len(order), np.int64)
        count = np.empty(len(order), np.int64)
        first[order] = np.cumsum(by_part) - by_part
        count[order] = by_part
        codes = unpacked(row["codes"], np.uint32)
        del by_part, order, right
        table, at, size = shared.value[1], 0, 0
        found_ids, found_texts, pieces = [], [], []
        for n, check in zip(row["counts"], row["checks"]):
            word = codes[at : at + n]
            at += n
            chosen = ids[repeated_ranges(first[word], count[word])].astype("<u4")
            decoded = table.decode(chosen)
            if zlib.crc32(decoded.encode()) != check:
                raise ValueError("ids do not decode to their text")
            if found_texts and size + len(decoded) > OUT_PIECE:
                pieces.append(_out_piece(found_ids, found_texts))
                found_ids, found_texts, size = [], [], 0
            found_ids.append(chosen.tobytes())
            found_texts.append(decoded)
            size += len(decoded)
        pieces.append(_out_piece(found_ids, found_texts))
        # Each piece goes to Spark by itself.
        whole, keys = pa.Table.from_batches(pieces), left.column("keys").combine_chunks().flatten()
        trim()
        return whole.add_column(0, "key", keys)

    lists = rows.mapInArrow(word_lists, "part int, block long, words binary")
    replies = lists.groupBy("part").applyInArrow(
        encoded, "part int, block long, lengths binary, ids binary"
    )
    texts = rows.mapInArrow(
        coded,
        f"block long, keys array<{key_type}>, counts array<long>, checks array<long>, "
        "parts binary, codes binary",
    )
    done = (
        texts.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(assembled, f"key {key_type}, ids binary, decoded string")
    )
    return done.select(F.col("key").alias(key), "ids", "decoded")


def _out_piece(ids: list[bytes], texts: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["ids", "decoded"])


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed_words(found: list[str]) -> bytes:
    """Words with their lengths, so that a word may hold any character."""
    coded = [w.encode() for w in found]
    sizes = packed(np.array([*map(len, coded)], np.uint32))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(coded), 3)


def _unpacked_words(data: bytes) -> pa.LargeStringArray:
    cut = 4 + int.from_bytes(data[:4], "little")
    sizes = unpacked(data[4:cut], np.uint32)
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])
    body = zstandard.decompress(data[cut:])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(body))


class _Pieces:
    """The id-to-piece table as one byte array."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        chosen = repeated_ranges(self.starts[ids], self.lengths[ids])
        return self.data[chosen].tobytes().decode("utf-8", "replace")


def decode(df: DataFrame, tokenizer_file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with its binary ``ids`` decoded; an id beyond the vocabulary is an error."""
    with open(tokenizer_file, encoding="utf-8") as file:
        pieces = df.sparkSession.sparkContext.broadcast(_Pieces(pieces_of(file.read())))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pieces.value
        for batch in batches:
            found = [
                None if b is None else table.decode(np.frombuffer(b, "<u4").astype(np.int64)) for b in batch.to_pylist()
            ]
            yield pa.array(found, pa.string())

    udf = F.arrow_udf(run, "string")
    return df.withColumn(into, udf(named(ids)))
