"""Language of whole texts and of spans in them.

A word's script narrows the languages it can belong to; each candidate scores
it by the character trigrams it is made of; a Viterbi pass over a document's
words finds the labels with the best total score when every change of language
costs a penalty. Scores are table look-ups over whole arrays of characters, and
the Viterbi pass goes through the words of many documents side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions import named
from veilframe.llm.arrays import record_pieces, with_columns_of_text

UNKNOWN = "und"
BUCKETS = 1 << 17
TRAIN_ROWS = 20_000
PIECE = 256 << 10
SIDE_BY_SIDE = 16

# The ranges of letters that decide a script; other letters form script 0.
SCRIPTS = (
    (0x0041, 0x024F),  # Latin
    (0x0370, 0x03FF),  # Greek
    (0x0400, 0x052F),  # Cyrillic
    (0x0530, 0x058F),  # Armenian
    (0x0590, 0x05FF),  # Hebrew
    (0x0600, 0x077F),  # Arabic
    (0x0900, 0x097F),  # Devanagari
    (0x0E00, 0x0E7F),  # Thai
    (0x1E00, 0x1EFF),  # Latin, additional
    (0x3040, 0x30FF),  # Kana
    (0x3400, 0x9FFF),  # Han
    (0xAC00, 0xD7A3),  # Hangul
)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point its small letter, 0 if it is no letter, and its script."""
    small = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            small[point] = ord(low) if len(low) == 1 else point
    script = np.zeros(0x110000, np.uint8)
    for i, (low, high) in enumerate(SCRIPTS):
        script[low : high + 1] = i + 1
    return small, script


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # language × trigram bucket, log-probability
    allowed: np.ndarray  # script × language
    fits: np.ndarray  # language × trigram bucket, 0 if never learned, 1 on average over what was


def held_out(key: str) -> Column:
    """Rows that no model learns from: the checksum of the key leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(named(key).cast("string")) % 4 == 2, F.lit(False))


def _piece(texts: list[str | None]):
    """Small letters, scripts, trigram buckets, word bounds and the owner of each word."""
    small_of, script_of = _tables()
    joined = "\n".join(t or "" for t in texts)
    lengths = np.array([len(t or "") for t in texts], np.int64)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.zeros(len(points) + 2, np.uint64)
    small[1:-1] = small_of[points]
    letter = small != 0
    edges = np.diff(letter.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    owner = np.searchsorted(firsts, starts, side="right") - 1
    inside = np.flatnonzero(letter)
    code = small[inside - 1] * np.uint64(0x9E3779B97F4A7C15)
    code = (code ^ small[inside]) * np.uint64(0xC2B2AE3D27D4EB4F)
    code ^= code >> np.uint64(29)
    code = (code ^ small[inside + 1]) * np.uint64(0x165667B19E3779F9)
    bucket = (code >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
    sizes = ends - starts
    script = script_of[points[starts]] if len(starts) else np.zeros(0, np.uint8)
    return script, bucket, starts, sizes, owner, firsts


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
    rows: int = TRAIN_ROWS,
) -> Model:
    """Learn from about ``rows`` labelled rows, spread over all by a hash of their key.

    Held-out rows and rows without text or language are not used. What comes to
    the driver is a count per language and trigram bucket.
    """
    labelled = docs.filter(~held_out(key) & named(language).isNotNull() & named(text).isNotNull())
    total = labelled.count()
    share = min(1.0, rows / total) if total else 1.0
    chosen = labelled.filter(F.pmod(F.xxhash64(named(key)), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = chosen.select(named(language).cast("string").alias("lang"), named(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in record_pieces(batches, "text", PIECE):
            langs = np.array(piece.column("lang").to_pylist(), object)
            script, bucket, _, sizes, owner, _ = _piece(piece.column("text").to_pylist())
            of_letter = np.repeat(owner, sizes)
            for name in set(langs):
                mine = langs == name
                both = sums.setdefault(name, np.zeros(BUCKETS + 256, np.int64))
                both[:BUCKETS] += np.bincount(bucket[mine[of_letter]], minlength=BUCKETS)
                words = mine[owner]
                both[BUCKETS:] += np.bincount(script[words], sizes[words], minlength=256).astype(np.int64)
        for name, both in sums.items():
            at = np.flatnonzero(both)
            yield pa.record_batch(
                [pa.array([name] * len(at)), pa.array(at, pa.int64()), pa.array(both[at])],
                ["lang", "at", "n"],
            )

    counted = chosen.mapInArrow(count, "lang string, at long, n long")
    grouped = counted.groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found = grouped.groupBy("lang").agg(
        F.collect_list("at").alias("at"), F.collect_list("n").alias("n")
    )
    by_language = {
        r["lang"]: (np.array(r["at"], np.int64), np.array(r["n"], np.int64)) for r in found.collect()
    }
    languages = sorted(by_language)
    scores = np.zeros((len(languages), BUCKETS), np.float32)
    fits = np.zeros((len(languages), BUCKETS), np.float32)
    allowed = np.zeros((256, len(languages)), bool)
    for i, name in enumerate(languages):
        both = np.zeros(BUCKETS + 256)
        both[by_language[name][0]] = by_language[name][1]
        smooth = both[:BUCKETS] + 0.5
        scores[i] = np.log(smooth / smooth.sum())
        if both[:BUCKETS].any():
            above = scores[i] - np.log(0.5 / smooth.sum())
            fits[i] = above / np.average(above, weights=both[:BUCKETS])
        letters = both[BUCKETS:]
        allowed[:, i] = letters >= 0.005 * max(letters.sum(), 1)
    if languages:
        # Only differences count, and no trigram may decide alone.
        scores -= scores.max(axis=0)
        np.maximum(scores, -4, out=scores)
    return Model(languages, scores, allowed, fits)


def viterbi(scores: np.ndarray, firsts: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; ``scores`` is word × label, documents back to back.

    Documents go side by side while there are many; the last words of the
    longest ones go one document after the other.
    """
    n, labels = scores.shape
    back = np.zeros((n, labels), np.uint8 if labels < 256 else np.int32)
    label = np.zeros(n, np.int64)
    order = np.argsort(-counts, kind="stable")
    firsts, counts = firsts[order], counts[order]
    state = np.zeros((len(order), labels), np.float64)
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(longest), side="left")
    wide = int(np.searchsorted(-active, -SIDE_BY_SIDE, side="right")) if longest else 0
    own = np.arange(labels)
    for t in range(wide):
        k = active[t]
        at = firsts[:k] + t
        now = state[:k]
        best = now.argmax(axis=1)
        change = now[np.arange(k), best] - penalty
        stay = now >= change[:, None]
        back[at] = np.where(stay, own, best[:, None])
        state[:k] = np.where(stay, now, change[:, None]) + scores[at]
    for d in range(int(active[wide]) if wide < longest else 0):
        now = state[d].tolist()
        a, b = int(firsts[d]) + wide, int(firsts[d] + counts[d])
        for i, row in zip(range(a, b), scores[a:b].tolist()):
            top = max(now)
            best, change = now.index(top), top - penalty
            back[i] = [j if x >= change else best for j, x in enumerate(now)]
            now = [(x if x >= change else change) + y for x, y in zip(now, row)]
        state[d] = now
    # Backwards: the last label, then what it came from.
    current = state.argmax(axis=1)
    for d in range(int(active[wide]) if wide < longest else 0):
        a, b, c = int(firsts[d]) + wide, int(firsts[d] + counts[d]), int(current[d])
        for i, came in zip(range(b - 1, a - 1, -1), back[a:b][::-1].tolist()):
            label[i] = c
            c = came[c]
        current[d] = c
    for t in range(wide - 1, -1, -1):
        k = active[t]
        at = firsts[:k] + t
        label[at] = current[:k]
        current[:k] = back[at, current[:k]]
    return label


def _word_scores(model: Model, script, bucket, sizes) -> np.ndarray:
    scores = np.empty((len(sizes), len(model.languages)))
    at = np.cumsum(sizes) - sizes
    for i in range(len(model.languages)):
        scores[:, i] = np.add.reduceat(model.scores[i][bucket], at)
    allowed = model.allowed[script]
    some = allowed.any(axis=1)
    # A script that no language uses says nothing.
    scores[~some] = 0
    scores[some[:, None] & ~allowed] = -1e4
    return scores


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(
    docs: DataFrame, model: Model, text: str = "text", penalty: float = 8.0,
    pred: str = "lang_pred", score: str = "lang_score", spans: str = "lang_spans",
    fit: str = "lang_fit",
) -> DataFrame:
    """``docs`` with the language of each text, its score, the spans by language, and the fit.

    The language is the one whose spans hold most letters, ties to the first in
    alphabetical order. The fit says how well the letters' trigrams are those
    of the language they are labelled with: 1 is what that language has on
    average, 0 trigrams that it does not have, and letters in scripts that no
    language uses count with 0. The score is the part of the fit that the
    letters of the text's language make up, their share if they fit fully. Both
    lie within 0 and 1. NULL texts, texts without a letter, and all texts if
    nothing was learned, are ``und`` with score and fit 0 and no spans. Spans
    count code points. Rows and other columns stay; columns of the four new
    names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = {pred: "string", score: "double", spans: SPANS, fit: "double"}
    return with_columns_of_text(
        docs, text, made, lambda texts: _identified(texts.to_pylist(), shared.value, penalty), PIECE
    )


def _identified(texts: list, model: Model, penalty: float) -> list[pa.Array]:
    n = len(texts)
    languages = np.array([*model.languages, UNKNOWN], object)
    pred, score, fit = np.full(n, len(model.languages)), np.zeros(n), np.zeros(n)
    offsets = np.zeros(n + 1, np.int64)
    starts = ends = labels = np.zeros(0, np.int64)
    script, bucket, word, sizes, owner, firsts = _piece(texts)
    if model.languages and len(word):
        counts = np.bincount(owner, minlength=n)
        first = np.cumsum(counts) - counts
        some = np.flatnonzero(counts)
        label = viterbi(_word_scores(model, script, bucket, sizes), first[some], counts[some], penalty)
        letters = np.bincount(owner * len(model.languages) + label, sizes, n * len(model.languages))
        letters = letters.reshape(n, -1)
        total = letters.sum(axis=1)
        pred = np.where(total > 0, letters.argmax(axis=1), pred)
        each = np.add.reduceat(model.fits[np.repeat(label, sizes), bucket], np.cumsum(sizes) - sizes)
        each[~model.allowed[script].any(axis=1)] = 0
        fitting = np.bincount(owner * len(model.languages) + label, each, n * len(model.languages))
        # What is likelier than the average makes up for no other language.
        fitting = np.minimum(fitting.reshape(n, -1), letters) / np.maximum(total, 1)[:, None]
        fit = np.minimum(fitting.sum(axis=1), 1)
        score = fitting[np.arange(n), letters.argmax(axis=1)]
        begins = np.ones(len(word), bool)
        begins[1:] = (owner[1:] != owner[:-1]) | (label[1:] != label[:-1])
        at = np.flatnonzero(begins)
        last = np.append(at[1:], len(word)) - 1
        starts = word[at] - firsts[owner[at]]
        ends = word[last] + sizes[last] - firsts[owner[at]]
        labels = label[at]
        offsets[1:] = np.cumsum(np.bincount(owner[at], minlength=n))
    struct = pa.StructArray.from_arrays(
        [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(languages[labels], pa.string())],
        ["start", "end", "lang"],
    )
    return [
        pa.array(languages[pred], pa.string()),
        pa.array(score, pa.float64()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct),
        pa.array(fit, pa.float64()),
    ]
