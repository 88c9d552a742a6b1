"""Personal data against the regular expressions that define its base kinds."""

import hashlib
import random
import re
import time

from veilframe.llm.pii import find_pii, luhn, redact, spans_of
from veilframe.llm.queries import QUERIES

from .conftest import FOLDER

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_base_kinds_on_random_texts():
    draw = random.Random(5)
    for alphabet in ("a1.@+- (4b0é%", "0123456789. -+", "a@.b-"):
        for _ in range(8000):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 45)))
            assert [s for s in spans_of(text) if s[0] in BASE] == brute(text), text


def test_base_kinds_on_the_whole_table(documents):
    for text in documents.values():
        assert [s for s in spans_of(text or "") if s[0] in BASE] == brute(text or "")


def test_addresses_and_accounts():
    text = "See https://www.example.org/a?b=c, or www.example.net. Account no: DE4412345, user id 77a, iban: GB12 x."
    found = [(k, text[a:b]) for k, a, b in spans_of(text)]
    assert ("url", "https://www.example.org/a?b=c") in found and ("url", "www.example.net") in found
    assert ("account", "DE4412345") in found and not any(v == "77a" for _, v in found)


def test_long_texts_take_linear_time():
    for text in ("1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1" * 200_000, "://" * 130_000, "account " * 50_000):
        spans_of(text)


def test_rows_and_columns_stay(stored_docs):
    docs = stored_docs([(1, "x a@b.co y"), (1, "x a@b.co y"), (None, None), (2, ""), (3, "+1 (988) 555-2485 🙂 1.2.3.4")])
    got = find_pii(docs)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == 5  # its own "pii" is replaced
    by_id = {r.doc_id: r for r in got.collect()}
    assert [tuple(s) for s in by_id[1].pii] == [("email", 2, 8, "a@b.co")]
    assert by_id[None].pii == [] and [s.kind for s in by_id[3].pii] == ["ip", "phone"]
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    assert clean == {1: "x [EMAIL] y", None: None, 2: "", 3: "[PHONE] 🙂 [IP]"}
    assert redact(docs).columns == [c for c in docs.columns]
    assert find_pii(stored_docs([])).count() == 0


def test_overlapping_spans_are_hidden_together(stored_docs):
    docs = stored_docs([(1, "at https://u:p@host.example.com/x end")], extra=False)
    text = redact(docs).head().text
    assert "host" not in text and text.startswith("at [") and text.endswith(" end")


def test_many_spans_in_one_text_and_names(stored_docs):
    text = "mail a.b@example.com or 10.0.0.1, " * 50_000
    docs = stored_docs([(1, text), (2, None), (3, "nothing")])
    for name in ("pii__of", "__pii", "__pii__of", "text_"):
        docs = docs.selectExpr("*", f"'mine' AS `{name}`")
    began = time.monotonic()
    rows = {r.doc_id: r for r in redact(docs).collect()}
    assert time.monotonic() - began < 60
    assert rows[1].text == "mail [EMAIL] or [IP], " * 50_000 and rows[2].text is None and rows[3].text == "nothing"
    assert redact(docs).columns == docs.columns
    assert all(r["pii__of"] == r["__pii"] == r["__pii__of"] == r.text_ == "mine" for r in rows.values())
    found = {r.doc_id: r for r in find_pii(docs).collect()}
    assert len(found[1].pii) == 100_000 and found[2].pii == found[3].pii == [] and found[1]["pii__of"] == "mine"


def test_query_digests(spark, documents):
    rows = QUERIES["op4_pii_anchors"](spark, FOLDER).collect()
    assert len(rows) == len(documents)
    for r in rows:
        spans = [f"{k}:{a}:{b}" for k, a, b in spans_of(documents[r.doc_id] or "")]
        base = [s for s in spans if s.split(":")[0] in ("email", "ip", "card", "phone")]
        assert r.spans == ",".join(spans)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        counts = [sum(s.startswith(k) for s in base) for k in ("email", "ip", "card", "phone")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
