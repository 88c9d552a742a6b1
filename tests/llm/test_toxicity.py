"""Toxicity: features, held-out quality, edge cases."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from veilframe.llm.queries import QUERIES
from veilframe.llm.toxicity import (
    FEATURES,
    Lexicon,
    _hashes,
    features_of,
    learn_lexicon,
    score_texts,
    train,
)
from veilframe.sources.tables import shared_folder

HASHES = _hashes([b"idiot", b"fool"])
LEXICON = Lexicon(np.sort(HASHES), np.ones(2))


def features(*texts):
    found = features_of(pa.array(texts, pa.string()), LEXICON)
    return [dict(zip(FEATURES, row)) for row in found]


def test_features():
    plain, near, far, loud, odd, none, empty = features(
        "nothing here", "You idiot", "you " + "x " * 30 + "idiot", "AN IDIOT!!!", "an id10t and an 1di0t", None, ""
    )
    assert plain["lexicon_count"] == 0 and near["lexicon_rate"] == 50 and near["near_second_person"] == 50
    assert far["near_second_person"] == 0 and far["lexicon_count"] > 0
    assert loud["capital_words"] > 0 and loud["repeated_marks"] > 0 and loud["capitals"] == 1
    assert odd["hidden_lexicon"] > 0 and odd["lexicon_count"] == 0
    assert set(none.values()) == {0.0} == set(empty.values())


def test_a_text_scores_alike_wherever_it_stands():
    texts = ["you fool", "fool", "You\n", "1di0t you", "", "you"]
    alone = [features(t)[0] for t in texts]
    assert features(*texts) == alone


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_toxicity_trees"](spark, folder).collect()]
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    true = sum(r.predicted and labels[r.doc_id] for r in held)
    assert true >= 0.85 * sum(labels[r.doc_id] for r in held)
    assert true >= 0.9 * sum(r.predicted for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_edge_cases(spark, stored_docs):
    docs = stored_docs([(i, "you idiot" if i % 4 == 0 else f"word{i % 7} here") for i in range(400)] + [(900, None), (None, ""), (901, "x" * 200_000), (0, "again")])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = train(docs, labels)
    got = score_texts(docs, model)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"] and got.count() == 404
    scores = {(r.doc_id, r.text[:9] if r.text else r.text): r.score for r in got.collect()}
    assert scores[(4, "you idiot")] > 0.5 > scores[(1, "word1 her")]
    nothing = train(stored_docs([]), labels.limit(0))
    assert {r.score for r in score_texts(docs, nothing).collect()} == {0.0}
    assert score_texts(stored_docs([]), model).count() == 0


def brute_lexicon(rows):
    """``word -> weight`` by counting in plain Python."""
    bad, good, n = Counter(), Counter(), Counter(y for _, y in rows)
    for text, y in rows:
        found = set(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower()))
        (bad if y else good).update(found)
    ratio = {w: ((bad[w] + 0.1) / n[1]) / ((good[w] + 0.1) / n[0]) for w in bad}
    return {w: math.log(r) for w, r in ratio.items() if bad[w] >= 5 and r >= 10}


def test_the_lexicon_has_every_word_that_meets_the_rule(spark):
    draw = random.Random(3)
    marks = [f"mark{i}" for i in range(600)]
    rows = []
    for i in range(9000):
        y = int(i % 3 == 0)
        words = [f"common{draw.randrange(50)}" for _ in range(8)]
        words += [draw.choice(marks).upper()] * 2 if y or draw.random() < 0.02 else []
        rows.append((" ".join(words), y))
    lexicon = learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    wanted = brute_lexicon(rows)
    assert 256 < len(wanted) < 600
    assert dict(zip(lexicon.hashes.tolist(), lexicon.weights.tolist())).keys() == set(_hashes(list(wanted)).tolist())
    for word, weight in wanted.items():
        assert math.isclose(lexicon.of(_hashes([word]))[0], weight, rel_tol=1e-12)
    # A bound keeps those with the most evidence.
    few = learn_lexicon(spark.createDataFrame(rows, "text string, y int"), limit=100)
    assert len(few.hashes) == 100 and set(few.hashes.tolist()) < set(lexicon.hashes.tolist())


def test_scores_are_those_of_the_trees_and_the_calibration_by_hand(spark, stored_docs):
    """Features, trees and steps of the calibration walked in plain Python."""
    draw = random.Random(8)
    bad, plain = ["idiot", "fool", "scum"], ["you", "the", "a", "house", "tree", "run", "HOT", "!!"]
    rows = []
    for i in range(600):
        words = [draw.choice(plain) for _ in range(draw.randint(3, 12))]
        words += [draw.choice(bad)] * (i % 5 == 0)
        rows.append((i, " ".join(words)))
    docs = stored_docs(rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0 or i % 41 == 0)) for i in range(600)], "doc_id long, toxic int")
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    model = train(docs, labels)
    assert set(os.listdir(folder)) == before
    found = features_of(pa.array([t for _, t in rows]), model.lexicon)

    def walk(node, x):
        while node.numDescendants():
            split = node.split()
            left = x[split.featureIndex()] <= split.threshold()
            node = node.leftChild() if left else node.rightChild()
        return node.prediction()

    trees = [(w, t._call_java("rootNode")) for w, t in zip(model.trees.treeWeights, model.trees.trees)]
    bounds, values = list(model.calibration.boundaries), list(model.calibration.predictions)
    wanted = {}
    for (key, _), x in list(zip(rows, found))[::7]:
        margin = sum(w * walk(root, x) for w, root in trees)
        raw = 1 / (1 + math.exp(-2 * margin))
        wanted[key] = min(max(float(np.interp(raw, bounds, values)), 0.0), 1.0)
    got = {r.doc_id: r.score for r in score_texts(docs, model).collect()}
    for key, score in wanted.items():
        assert math.isclose(got[key], score, abs_tol=1e-9)
    assert len(set(wanted.values())) > 2


def test_names_that_the_models_might_use(spark, stored_docs):
    docs = stored_docs([(i, "you idiot" if i % 4 == 0 else f"word{i % 7} here") for i in range(200)])
    for name in ("__x", "text_", "x_", "x__of", "raw", "prediction", "probability", "features", "y"):
        docs = docs.withColumn(name, F.lit("mine"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = score_texts(docs, train(docs, labels))
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert all(r["__x"] == r.prediction == "mine" for r in got.collect())
