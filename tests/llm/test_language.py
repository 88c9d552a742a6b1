"""Language: the Viterbi pass against brute force, accuracy on held-out rows, edge cases."""

import itertools

import duckdb
import numpy as np
import pytest

from veilframe.llm import language

from .conftest import FOLDER


@pytest.mark.parametrize("side_by_side", [1, 3, 100])
def test_viterbi_finds_the_best_labels(monkeypatch, side_by_side):
    monkeypatch.setattr(language, "SIDE_BY_SIDE", side_by_side)
    draw = np.random.default_rng(1)
    counts = draw.integers(1, 7, 12)
    firsts = np.cumsum(counts) - counts
    scores = draw.normal(size=(counts.sum(), 3))

    def value(labels, at):
        own = sum(scores[at + i, y] for i, y in enumerate(labels))
        return own - 0.8 * sum(a != b for a, b in zip(labels, labels[1:]))

    got = language.viterbi(scores, firsts, counts, 0.8)
    for at, n in zip(firsts, counts):
        best = max(itertools.product(range(3), repeat=int(n)), key=lambda x: value(x, at))
        assert value(got[at : at + n].tolist(), at) == pytest.approx(value(best, at))


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language.identify(docs, model).filter(language.held_out("doc_id")).collect()
    assert len(found) > 200
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.lang_score <= 1 for r in found)


def test_mixed_texts_are_labelled_by_span(spark, model, stored_docs):
    texts = dict(duckdb.sql(f"SELECT lang, min(text) FROM '{FOLDER}/documents.parquet' WHERE length(text) > 600 "
                            "AND text NOT LIKE '%|%' AND text NOT LIKE '%$%' GROUP BY lang").fetchall())
    mixed = texts["en"][:500] + "\n" + texts["fr"][:500]
    row = language.identify(stored_docs([(1, mixed)], extra=False), model).head()
    english = sum(s.end - s.start for s in row.lang_spans if s.lang == "en" and s.end <= 520)
    french = sum(s.end - s.start for s in row.lang_spans if s.lang == "fr" and s.start >= 480)
    assert english > 400 and french > 400 and 0.4 < row.lang_score < 0.65


def test_edge_cases(model, stored_docs):
    rows = [(1, None), (2, ""), (3, "123 ... !"), (4, "漢字"), (None, "the of and that"), (5, "a" * 300_000), (5, "the " * 60_000)]
    docs = stored_docs(rows)
    got = {(r.doc_id, len(r.text or "")): r for r in language.identify(docs, model).collect()}
    assert len(got) == len(rows)
    for key in ((1, 0), (2, 0), (3, 9)):
        assert (got[key].lang_pred, got[key].lang_score, got[key].lang_spans) == ("und", 0.0, [])
    assert got[(4, 2)].lang_pred in model.languages and got[(5, 240_000)].lang_pred == "en"
    nothing = language.train(stored_docs([], "doc_id long, text string, lang string", extra=False))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(stored_docs([]), model).count() == 0


def test_scripts_that_no_language_uses_do_not_score(model, stored_docs):
    rows = [(1, "Все люди рождаются свободными"), (2, "人人生而自由"), (3, "the of and that"), (4, "the of and that Все люди рождаются")]
    got = {r.doc_id: r for r in language.identify(stored_docs(rows), model).collect()}
    assert all((got[i].lang_score, got[i].lang_fit) == (0.0, 0.0) for i in (1, 2))
    assert got[3].lang_score > 0.8 and got[3].lang_fit >= got[3].lang_score
    assert 0 < got[4].lang_fit < 0.5


def test_names_that_the_operator_might_use(stored_docs):
    docs = stored_docs([(1, "the cat and the dog are here", "en"), (4, "der Hund und die Katze sind da", "de")], "doc_id long, text string, lang string")
    for name in ("lang_pred__of", "text_", "__pred"):
        docs = docs.selectExpr("*", f"'mine' AS `{name}`")
    got = language.identify(docs, language.train(docs))
    assert got.columns == [*docs.columns, "lang_pred", "lang_score", "lang_spans", "lang_fit"]
    assert all(r["lang_pred__of"] == r.text_ == "mine" and r.row == "extra" for r in got.collect())
    # A column that has a new name already is replaced.
    again = language.identify(got, language.train(docs))
    assert sorted(again.columns) == sorted(got.columns)


def words_by_hand(text):
    """``(start, small letters)`` of the runs of letters."""
    found, at = [], None
    low = [c.lower() if len(c.lower()) == 1 else c for c in text]
    for i, c in enumerate([*text, " "]):
        if c.isalpha() and at is None:
            at = i
        elif not c.isalpha() and at is not None:
            found.append((at, low[at:i]))
            at = None
    return found


def bucket_by_hand(before, letter, behind):
    mask = (1 << 64) - 1
    code = before * 0x9E3779B97F4A7C15 & mask
    code = (code ^ letter) * 0xC2B2AE3D27D4EB4F & mask
    code ^= code >> 29
    return ((code ^ behind) * 0x165667B19E3779F9 & mask) >> 40 & (language.BUCKETS - 1)


def buckets_by_hand(word):
    points = [0, *map(ord, word), 0]
    return [bucket_by_hand(*points[i : i + 3]) for i in range(len(word))]


def script_by_hand(text, at):
    return max((i + 1 for i, (a, b) in enumerate(language.SCRIPTS) if a <= ord(text[at]) <= b), default=0)


def identified_by_hand(text, model, penalty=8.0):
    """Prediction, score, spans and fit, a word and a label at a time."""
    words = words_by_hand(text or "")
    if not words:
        return "und", 0.0, [], 0.0
    names = range(len(model.languages))
    scores, each = [], []
    for at, word in words:
        allowed = model.allowed[script_by_hand(text, at)]
        own = [sum(float(model.scores[i][b]) for b in buckets_by_hand(word)) for i in names]
        scores.append([(x if allowed[i] else -1e4) if any(allowed) else 0.0 for i, x in enumerate(own)])
        fit = [sum(float(model.fits[i][b]) for b in buckets_by_hand(word)) for i in names]
        each.append(fit if any(allowed) else [0.0] * len(fit))
    best, came = [scores[0]], []
    for row in scores[1:]:
        step = [max(((best[-1][j] - penalty * (j != i), j == i, -j) for j in names)) for i in names]
        came.append([i if same else -j for i, (_, same, j) in enumerate(step)])
        best.append([x + y[0] for x, y in zip(row, step)])
    labels = [max(names, key=lambda i: (best[-1][i], -i))]
    for back in reversed(came):
        labels.insert(0, back[labels[0]])
    letters, fitting = [0] * len(names), [0.0] * len(names)
    for (_, word), label, fit in zip(words, labels, each):
        letters[label] += len(word)
        fitting[label] += fit[label]
    total, top = sum(letters), max(names, key=lambda i: (letters[i], -i))
    part = [min(f, n) / total for f, n in zip(fitting, letters)]
    spans = []
    for (at, word), label in zip(words, labels):
        if spans and spans[-1][2] == model.languages[label]:
            spans[-1] = (spans[-1][0], at + len(word), spans[-1][2])
        else:
            spans.append((at, at + len(word), model.languages[label]))
    return model.languages[top], part[top], spans, min(sum(part), 1.0)


def test_identification_by_hand(model, stored_docs, documents):
    some = [t for t in documents.values() if t][:25]
    texts = [t[:400] for t in some] + [a[:60] + " " + b[100:160] + " " + c[:50] for a, b, c in zip(some, some[5:], some[9:])]
    texts += ["Straße ИМЯ the İx", "漢字 and words", "a1b2c3", "É", "x" * 50, None, "", "...", "naïve café, déjà vu!"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in language.identify(stored_docs(rows), model).collect()}
    for key, text in rows:
        pred, score, spans, fit = identified_by_hand(text, model)
        r = got[key]
        assert r.lang_pred == pred and [(s.start, s.end, s.lang) for s in r.lang_spans] == spans, text
        assert (r.lang_score, r.lang_fit) == pytest.approx((score, fit), abs=1e-4)
    assert len({s.lang for r in got.values() for s in r.lang_spans}) >= 3


def test_the_model_is_made_of_counts(stored_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat", "en"), ("der Hund, die", "de"), ("le chat", "fr"), ("Имя", "ru"), ("cat", "en")] * 3)]
    model = language.train(stored_docs(rows, "doc_id long, text string, lang string"))
    import zlib

    counts = {}
    for key, text, lang in rows:
        if zlib.crc32(str(key).encode()) % 4 != 2:
            for _, word in words_by_hand(text):
                counts.setdefault(lang, []).extend(buckets_by_hand(word))
    assert model.languages == sorted(counts)
    raw = np.full((len(counts), language.BUCKETS), 0.5)
    for i, lang in enumerate(model.languages):
        np.add.at(raw[i], counts[lang], 1)
    raw = np.log(raw / raw.sum(axis=1, keepdims=True))
    assert np.allclose(model.scores, np.maximum(raw - raw.max(axis=0), -4), atol=1e-5)
