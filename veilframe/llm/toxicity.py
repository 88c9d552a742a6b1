"""Toxicity of whole texts: boosted trees over dense features, with calibrated scores.

The lexicon is learned: words that mark toxic rows among all labelled rows.
Features are densities of lexicon words, their closeness to a second-person
pronoun, capitals, punctuation and signs of obfuscation, all computed over
arrays of bytes. Spark's gradient-boosted trees learn from one part of the
training rows and an isotonic regression calibrates them on the other.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import free_name, named
from veilframe.llm.arrays import (
    if_short,
    joined_utf8,
    span_hash,
    with_columns_of_text,
    words,
)
from veilframe.llm.language import held_out
from veilframe.sources import materialize, scratch

TRAIN_ROWS = 24_000
# A bound on the lexicon that every task holds, far above the words that labels set apart.
LEXICON = 1 << 20
NEAR = 4

# Second-person pronouns, in small letters.
SECOND_PERSON = ("you", "your", "yours", "youre", "ur", "u", "du", "dich", "dir", "dein", "deine",
                 "ihr", "euch", "tu", "te", "toi", "ton", "ta", "vous", "votre", "usted", "ti", "tus")
# Symbols and digits that stand for letters, and those letters.
LOOKALIKES = (b"@4$5013!7", b"aassoieit")

FEATURES = (
    "words", "lexicon_rate", "lexicon_count", "lexicon_kinds", "lexicon_weight", "lexicon_top",
    "second_person_rate", "near_second_person", "capitals", "capital_words", "exclamations",
    "repeated_marks", "obfuscated_rate", "hidden_lexicon", "single_letters", "starred_rate",
)


@dataclass
class Lexicon:
    hashes: np.ndarray  # sorted
    weights: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The weight of each word, 0 for those that are not in the lexicon."""
        return _looked_up(self.hashes, self.weights, hashes)


def _looked_up(known: np.ndarray, values: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, values[at], 0.0)


def _hashes(texts: list[bytes]) -> np.ndarray:
    spans = span_hash(11)
    found = []
    for text in texts:
        symbols = np.frombuffer(text, np.uint8)
        found.append(spans.spans(spans.sums(symbols), np.array([0]), np.array([len(symbols)]))[0])
    return np.array(found, np.uint64)


@lru_cache(maxsize=1)
def _second_person() -> np.ndarray:
    return np.sort(_hashes([w.encode() for w in SECOND_PERSON]))


@lru_cache(maxsize=1)
def _plain() -> tuple[np.ndarray, np.ndarray]:
    """Bytes with look-alikes as the letters they stand for, and which bytes are such."""
    table = np.arange(256, dtype=np.uint8)
    odd = np.zeros(256, bool)
    for symbol, letter in zip(*LOOKALIKES):
        table[symbol] = letter
        odd[symbol] = True
    return table, odd


def features_of(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Text × ``FEATURES``; a NULL or empty text has zeros."""
    data, starts, ends = joined_utf8(column)
    n = len(starts)
    spans = span_hash(11)
    folded, at, end = words(data)
    hashes = spans.spans(spans.sums(folded), at, end)
    owner = np.searchsorted(starts, at, side="right") - 1
    per = lambda mask, of=owner: np.bincount(of, mask, minlength=n)
    count = np.bincount(owner, minlength=n)
    rate = lambda x: 100 * x / np.maximum(count, 1)

    weight = lexicon.of(hashes)
    hit = weight > 0
    kinds = np.unique(np.stack([owner[hit].astype(np.uint64), hashes[hit]]), axis=1)[0].astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, owner[hit], weight[hit])
    you = _looked_up(_second_person(), np.ones(len(SECOND_PERSON)), hashes) > 0
    # A pronoun within NEAR words of the same text.
    you_at = np.flatnonzero(you)
    hit_at = np.flatnonzero(hit)
    near = np.zeros(len(hit_at), bool)
    if len(you_at):
        right = np.minimum(np.searchsorted(you_at, hit_at), len(you_at) - 1)
        for i in (right, np.maximum(right - 1, 0)):
            near |= (np.abs(you_at[i] - hit_at) <= NEAR) & (owner[you_at[i]] == owner[hit_at])

    byte_owner = np.repeat(np.arange(n), ends - starts + 1)
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    total = lambda mask: np.bincount(byte_owner[mask], minlength=n)
    uppers, letters = total(upper), total(upper | lower)
    marks = (data == 33) | (data == 63)
    repeated = marks.copy()
    repeated[1:] &= data[1:] == data[:-1]
    repeated[:1] = False
    size = np.maximum(ends - starts, 1)
    upper_sum = np.concatenate([[0], np.cumsum(upper)])
    length = end - at
    shouted = (upper_sum[end] - upper_sum[at] == length) & (length > 2)

    # Words that hide: letters with look-alikes or stars between them.
    table, odd = _plain()
    plain = table[data]
    plain_folded, p_at, p_end = words(plain)
    p_owner = np.searchsorted(starts, p_at, side="right") - 1
    p_hashes = spans.spans(spans.sums(plain_folded), p_at, p_end)
    odd_sum = np.concatenate([[0], np.cumsum(odd[data])])
    lower_sum = np.concatenate([[0], np.cumsum(upper | lower)])
    odds, plains = odd_sum[p_end] - odd_sum[p_at], lower_sum[p_end] - lower_sum[p_at]
    mixed = (odds > 0) & (plains >= 2) & (odds < plains)
    hidden = mixed & (lexicon.of(p_hashes) > 0)
    star = data == 42
    starred = np.zeros(len(data), bool)
    if len(data) > 2:
        letter = upper | lower
        starred[1:-1] = star[1:-1] & (letter[:-2] | star[:-2]) & (letter[2:] | star[2:])

    return np.stack(
        [
            np.log1p(count),
            rate(per(hit)),
            np.log1p(per(hit)),
            np.bincount(kinds, minlength=n),
            rate(per(weight)),
            top,
            rate(per(you)),
            rate(np.bincount(owner[hit_at], near, minlength=n)),
            uppers / np.maximum(letters, 1),
            rate(per(shouted)),
            100 * total(marks) / size,
            100 * total(repeated) / size,
            rate(per(mixed, p_owner)),
            rate(per(hidden, p_owner)),
            rate(per(length == 1)),
            100 * total(starred) / size,
        ],
        axis=1,
    )


def with_features(docs: DataFrame, lexicon: Lexicon, text: str, into: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def found(texts: pa.Array) -> list[pa.Array]:
        values = pa.array(features_of(texts, shared.value).reshape(-1))
        return [pa.FixedSizeListArray.from_arrays(values, len(FEATURES)).cast(pa.list_(pa.float64()))]

    return with_columns_of_text(docs, text, {into: "array<double>"}, found)


def learn_lexicon(rows: DataFrame, limit: int = LEXICON) -> Lexicon:
    """The words that set toxic rows of ``(text, y)`` apart.

    A word counts once a row. It is taken if at least five toxic rows have it
    and its rate among them is ten times that among the others; its weight is
    the logarithm of that ratio. Should more than ``limit`` words meet this,
    those stay whose excess over the expected number of toxic rows is the most
    unlikely, not the most frequent ones.
    """
    by_label = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not by_label.get(1) or not by_label.get(0):
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.array_distinct(F.regexp_extract_all(small, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), 0))
    counted = (
        rows.select("y", F.explode(found).alias("word"))
        .groupBy("word")
        .agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    )
    ratio = ((F.col("bad") + 0.1) / by_label[1]) / ((F.col("good") + 0.1) / by_label[0])
    share = by_label[1] / (by_label[0] + by_label[1])
    # Twice the logarithm of how much likelier the toxic rows are under their own rate.
    rate = F.col("bad") / (F.col("bad") + F.col("good"))
    left = F.when(F.col("good") > 0, F.col("good") * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    evidence = F.col("bad") * F.log(rate / share) + left
    best = (
        counted.filter("bad >= 5")
        .withColumns({"ratio": ratio, "evidence": evidence})
        .filter("ratio >= 10")
        .orderBy(F.desc("evidence"), "word")
        .limit(limit)
        .select("word", "ratio")
        .collect()
    )
    hashes = _hashes([r["word"].encode() for r in best])
    weights = np.log(np.array([r["ratio"] for r in best]))
    order = np.argsort(hashes)
    return Lexicon(hashes[order], weights[order])


@dataclass
class Model:
    lexicon: Lexicon
    trees: object = None
    calibration: object = None
    constant: float = 0.0


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "toxic", rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 4, seed: int = 7,
) -> Model:
    """Learn the lexicon from all labelled rows and the trees from about ``rows`` of them.

    Those are spread over all by a hash of their key. Held-out rows are not
    used. A key with several labels counts as toxic if one of them says so.
    Without labelled rows, or with labels of one class only, every score is the
    mean of the labels, or 0.
    """
    with scratch(docs.sparkSession):
        return _trained(docs, labels, key, text, label, rows, trees, depth, seed)


def _trained(docs, labels, key: str, text: str, label: str, rows: int, trees: int, depth: int, seed: int) -> Model:
    known = labels.filter(~held_out(key) & named(key).isNotNull() & named(label).isNotNull())
    known = known.groupBy(named(key).alias("key")).agg(F.max(named(label).cast("int")).alias("y"))
    known = materialize(known)
    total = known.count()
    texts = docs.select(named(key).alias("key"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    labelled = texts.join(if_short(known), "key")
    lexicon = learn_lexicon(labelled.select("text", "y"))
    share = min(1.0, rows / total) if total else 1.0
    sampled = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = materialize(labelled.filter(sampled))
    featured = with_features(sample, lexicon, "text", "x")
    featured = materialize(
        featured.select(
            "y", array_to_vector("x").alias("x"), (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(10)) < 7).alias("fit")
        ).coalesce(4)
    )
    classes = featured.groupBy("fit").agg(
        F.count("*").alias("n"), F.avg("y").alias("mean")
    ).collect()
    mean = sum(r["n"] * r["mean"] for r in classes) / max(sum(r["n"] for r in classes), 1)
    if len(classes) < 2 or any(r["mean"] in (0, 1) for r in classes):
        return Model(lexicon, constant=mean)
    learner = GBTClassifier(
        featuresCol="x", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=64, seed=seed
    )
    fitted = learner.fit(featured.filter("fit"))
    held = fitted.transform(featured.filter("not fit")).select(
        "y", vector_to_array("probability")[1].alias("raw")
    )
    calibration = IsotonicRegression(featuresCol="raw", labelCol="y").fit(held)
    return Model(lexicon, fitted, calibration)


def score_texts(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row, NULL and empty texts included.

    All other columns stay; a column that is called ``into`` is replaced.
    """
    kept = docs.drop(into)
    if model.trees is None:
        return kept.withColumn(into, F.lit(float(model.constant)))
    # Row as one struct, so that no column of it can clash with those of the models.
    features = free_name("x", kept)
    featured = with_features(kept, model.lexicon, text, features)
    packed = featured.select(F.struct(*map(named, kept.columns)).alias("row"), array_to_vector(features).alias("x"))
    raw = model.trees.transform(packed).select("row", vector_to_array("probability")[1].alias("raw"))
    done = model.calibration.transform(raw)
    score = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
    return done.select("row.*", score.alias(into))
