"""Personal data by anchors: an automaton finds cues, local parsers their extent.

One Aho-Corasick pass over a text reports at-signs, plus signs, schemes, digits
and the words that announce an account. From each anchor a deterministic parser
walks to the boundaries of the candidate and a validator keeps or drops it. No
parser reads a character again that it has passed, so the time is linear in the
text. Rows are independent of each other: nothing is shuffled.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from veilframe.functions import named
from veilframe.llm.arrays import with_columns_of_text

# The order in which a document's spans are listed.
KINDS = ("email", "ip", "card", "phone", "url", "account")

# Words that announce an account, written small, capitalized and large.
CUES = ("account", "acct", "iban", "passport", "customer id", "user id", "member id", "ssn")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ADDRESS = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
ACCOUNT = re.compile(r"(?: ?(?:no|nr|number|id)\b\.?)?[ ]?[:=#]?[ ]?([A-Z]{0,4}[0-9][A-Z0-9-]{3,33})(?![A-Za-z0-9])")

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"
SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    anchors = {"@": "email", "+": "phone", "://": "scheme", "www.": "www"}
    anchors |= {str(d): "digit" for d in range(10)}
    for cue in CUES:
        anchors |= dict.fromkeys((cue, cue.capitalize(), cue.upper()), "cue")
    for anchor, kind in anchors.items():
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def _octets(parts: list[str]) -> bool:
    short = [part.lstrip("0") for part in parts]
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in short)


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind in the order of ``KINDS``, then start."""
    found: dict[str, list[tuple[str, int, int]]] = {kind: [] for kind in KINDS}
    # Up to where each parser has read.
    done = dict.fromkeys(("email", "ip", "card", "phone", "url", "account"), 0)
    for last, (anchor, length) in _automaton().iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at >= done["ip"]:
                run = DOTTED.match(text, at)
                done["ip"] = run.end()
                parts, start = run.group().split("."), at
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    end = start + sum(map(len, four)) + 3
                    if _octets(four):
                        found["ip"].append(("ip", start, end))
                    start = end + 1
            if at >= done["card"]:
                run = DIGITS.match(text, at)
                done["card"] = run.end() if run else at + 1
                if run:
                    digits = run.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(("card", at, run.end()))
        elif anchor == "email":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            domain = DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                done["email"] = domain.end()
                found["email"].append(("email", start, domain.end()))
        elif anchor == "phone":
            run = PHONE.match(text, at)
            if run and 9 <= sum(c in "0123456789" for c in run.group()) <= 15:
                found["phone"].append(("phone", at, run.end()))
        elif anchor in ("scheme", "www"):
            start = at
            if anchor == "scheme":
                while start > done["url"] and text[start - 1] in SCHEME:
                    start -= 1
                while start < at and not (text[start].isascii() and text[start].isalpha()):
                    start += 1
            address = ADDRESS.match(text, last + 1)
            if address and start >= done["url"] and (anchor == "www" or start < at):
                end = address.end()
                while text[end - 1] in ".,;:!?)]}":
                    end -= 1
                done["url"] = end
                if end > last + 1:
                    found["url"].append(("url", start, end))
        elif at >= done["account"]:
            run = ACCOUNT.match(text, last + 1)
            if run and sum(c in "0123456789" for c in run.group(1)) >= 4:
                done["account"] = run.end(1)
                found["account"].append(("account", run.start(1), run.end(1)))
    return [span for kind in KINDS for span in found[kind]]


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with an array of ``(kind, start, end, value)`` for every row.

    Offsets count code points and ends are exclusive. A NULL or empty text has
    no spans; all rows and all other columns stay as they are. A column that is
    already called ``into`` is replaced.
    """

    def found(texts: pa.Array) -> list[pa.Array]:
        rows = [
            [{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in spans_of(t or "")]
            for t in texts.to_pylist()
        ]
        return [pa.array(rows, SPAN_TYPE)]

    return with_columns_of_text(docs, text, {into: SPANS}, found)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; linear in the text."""
    parts, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans_of(text)):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Spans that overlap are replaced together, under the kind of the first. A
    NULL text stays NULL; the columns keep their order, and ``text`` is a string.
    """

    def clean(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([None if t is None else redacted(t) for t in texts.to_pylist()], pa.string())]

    return with_columns_of_text(docs, text, {text: "string"}, clean).select(*map(named, docs.columns))
