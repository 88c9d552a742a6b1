"""Secrets: known shapes against regular expressions, the battery on random and ordinary runs."""

import hashlib
import math
import random
import re
import string
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veilframe.llm.queries import QUERIES
from veilframe.llm.secrets import BINS, ENCODINGS, RATE, find_secrets, least_length

from .conftest import FOLDER

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def spans(row):
    return [(s.kind, s.start, s.end) for s in row.secrets]


def known(row):
    return [s for s in spans(row) if s[0] != "random"]


def test_known_shapes(stored_docs, documents):
    draw = random.Random(2)
    pieces = ["token", "password=", "secret:", "API_key", " ", "=", ":", '"', "'", "AKIA", "deadbeef0123", "abcdef", "Z9",
              "é🙂", "x.y-z", "API-KEY", "\n", "ABCDEFGH12345678"]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(draw.randint(0, 14)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "a" * 100_000), (2003, "password=abcdef " * 3000), (None, "token: abcdef1"), (2002, "x")]
    rows += [(10_000 + k, t) for k, t in documents.items()]
    wanted = sorted((repr(k), brute(t or "")) for k, t in rows)
    assert sorted((repr(r.doc_id), known(r)) for r in find_secrets(stored_docs(rows)).collect()) == wanted


def test_random_runs_pass_and_words_do_not(stored_docs):
    draw = random.Random(4)
    symbols = string.ascii_letters + string.digits
    syllables = ["heit", "ung", "ver", "ein", "the", "tion", "ing", "ble", "con", "stein", "ment", "que"]
    rows = [(i, "see " + "".join(draw.choice(symbols) for _ in range(draw.randint(24, 60))) + " end") for i in range(300)]
    rows += [(1000 + i, "see " + "".join(draw.choice(syllables) for _ in range(12)) + " end") for i in range(300)]
    rows += [(2000, "a" * 40), (2001, "ab" * 30), (2002, "abcdefghijklmnopqrstuvwxyz0123456789"), (2003, "1" * 50), (2004, "_" * 70)]
    got = {r.doc_id: spans(r) for r in find_secrets(stored_docs(rows)).collect()}
    assert sum(any(s[0] == "random" for s in got[i]) for i in range(300)) >= 270
    assert sum(any(s[0] == "random" for s in got[1000 + i]) for i in range(300)) <= 6
    assert not any(s[0] == "random" for i in range(2000, 2005) for s in got[i])
    assert got[0][0][1] == 4


def test_added_spans_do_not_overlap_known_ones(stored_docs):
    text = "token=" + "aB3xY9kQ2mZ7pL4wT8vR1nC6" + " and AKIA" + "B2C4D6F8G1H3J5K7"
    row = find_secrets(stored_docs([(1, text)])).head()
    assert [s[0] for s in spans(row)] == ["assign", "access"]


def test_rows_columns_and_plan(stored_docs):
    docs = stored_docs([(1, "x"), (1, "x"), (None, None)])
    got = find_secrets(docs)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == 3
    assert find_secrets(stored_docs([])).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def upper_tail(z):
    z = max(min(z, 12.0), -12.0)
    return 1 / (1 + math.exp(1.5976 * z + 0.07056 * z**3))


def battery_of(token):
    """``(encoding number, p, stratum, reported)`` in plain Python."""
    number = next(i for i, (_, pattern, _) in enumerate(ENCODINGS) if re.search(pattern, token))
    alphabet, n = ENCODINGS[number][2], len(token)
    m, x = len(alphabet), [alphabet.find(c) for c in token]
    chi = m / n * sum(c * c for c in Counter(x).values()) - n
    even = upper_tail((chi - (m - 1)) / math.sqrt(2 * (m - 1) * (n - 1) / n))
    side = [float(v >= m / 2) for v in x]
    high = sum(side)
    mean = 2 * high * (n - high) / n + 1
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    changes = sum(a != b for a, b in zip(side, side[1:]))
    runs = 0.0 if high < 1 or high > n - 1 else 2 * upper_tail(abs(changes + 1 - mean) / spread)
    centre = sum(x) / n
    d = [v - centre for v in x]
    own = sum(v * v for v in d)
    beside = sum(a * b for a, b in zip(d, d[1:]))
    serial = 2 * upper_tail(abs(beside / own + 1 / n) * math.sqrt(n)) if own > 0 else 0.0
    p = min(1.0, 3 * min(even, runs, serial))
    return number, p, (number, math.floor(math.log2(n) * 2)), n >= least_length(m) and number > 0


def brute_random(texts):
    """The spans that pass: Benjamini and Hochberg per stratum over the distinct runs of the corpus."""
    run = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
    found = {key: [(m.start(), m.end(), m.group()) for m in run.finditer(text or "")] for key, text in texts.items()}
    tested = {token: battery_of(token) for spans_ in found.values() for _, _, token in spans_}
    bin_of = lambda p: min(math.floor(-20 * math.log10(max(p, 1e-30))), BINS)
    strata = {}
    for _, p, stratum, _ in tested.values():
        strata.setdefault(stratum, []).append(bin_of(p))
    limit = {}
    for stratum, bins in strata.items():
        ordinary = [b for b in set(bins) if 10 ** (-b / 20) <= RATE * sum(x >= b for x in bins) / len(bins)]
        limit[stratum] = min(ordinary, default=BINS + 1)
    passed = {}
    for key, spans_ in found.items():
        known_ = brute(texts[key] or "")
        for a, b, token in spans_:
            _, p, stratum, reported = tested[token]
            if reported and bin_of(p) < limit[stratum] and all(e <= a or b <= s for _, s, e in known_):
                passed.setdefault(key, []).append((a, b, p))
    return passed


def test_battery_and_false_discovery_control_by_brute_force(stored_docs):
    draw = random.Random(11)
    symbols = {"m": string.ascii_letters + string.digits, "x": "0123456789abcdef", "b": string.ascii_uppercase + "234567",
               "s": string.ascii_lowercase, "d": string.digits, "6": string.ascii_letters + string.digits + "+/"}
    syllables = ["heit", "ung", "ver", "ein", "the", "tion", "ing", "ble", "con", "Stein", "ment", "que", "4", "-"]

    def word(i):
        if i % 3:
            return "".join(draw.choice(syllables) for _ in range(draw.randint(5, 30)))
        return "".join(draw.choice(symbols[draw.choice("mxbsd6")]) for _ in range(draw.randint(20, 90)))

    texts = {i: " ".join(word(draw.randrange(9)) for _ in range(draw.randint(0, 5))) for i in range(700)}
    texts |= {1000 + i: f"password={word(0)} token: {word(1)}" for i in range(60)} | {2000: None, 2001: ""}
    wanted = brute_random(texts)
    assert sum(map(len, wanted.values())) > 100
    rows = {r.doc_id: r.secrets for r in find_secrets(stored_docs(list(texts.items()))).collect()}
    for key, text in texts.items():
        got = [(s.start, s.end, s.p) for s in rows[key] if s.kind == "random"]
        assert [g[:2] for g in got] == [w[:2] for w in wanted.get(key, [])]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in wanted.get(key, [])], rel=1e-9)
        for s in rows[key]:
            value = ASSIGN.match(s.value).group(2) if s.kind == "assign" else s.value
            number, p, _, _ = battery_of(value)
            assert s.encoding == ENCODINGS[number][0] and s.p == pytest.approx(p, rel=1e-9, abs=1e-15)


def test_query_digests(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op6_secret_tests"](spark, FOLDER).collect()}
    assert len(got) == len(documents)
    for key, text in documents.items():
        base = brute(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = got[key]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        counts = Counter(k for k, _, _ in base)
        assert (row.n_assign, row.n_access, row.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        rest = [s for s in row.spans.split(",") if s and not s.startswith("random:")]
        assert rest == [s for s in joined.split(",") if s] and len(row.tests) == row.spans.count(":") // 2


def test_many_hits_in_one_text_and_names(stored_docs):
    text = "deadbeefdeadbeefdeadbeef0123 " * 40_000 + "token=abcdef1 " * 20_000
    docs = stored_docs([(1, text), (2, "x")])
    for name in ("__known", "__runs", "__bins", "known", "runs", "bins", "p", "start"):
        docs = docs.withColumn(name, F.lit("mine"))
    began = time.monotonic()
    rows = {r.doc_id: r for r in find_secrets(docs).collect()}
    assert time.monotonic() - began < 60
    assert known(rows[1]) == brute(text) and rows[1].__getitem__("__known") == rows[2].bins == "mine"
