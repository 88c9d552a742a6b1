"""Span specs against fixed vectors and a character-by-character walk."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from veilframe.functions import part_delete, span_mask

VECTORS = [
    ("900101-1234567", "1:0-:1", "*9************7", "97"),
    ("홍길동", "1:0-:1", "*홍*동", "홍동"),
    ("ab", "1:0-:1", "*a*", "a"),
    ("a", "1:0-:1", "*a", "a"),
    ("", "1:0-:1", "*", ""),
    ("abcdef", "0:1-:0", "**bcde*", "bcde"),
    ("abcdef", "1:0", "*a*****", "a"),
    ("abcdef", "1-", "*abcdef", "abcdef"),
    ("abcdef", "0-", "*******", ""),
    ("abcdef", ":1", "******f", "f"),
    ("abcd", "0-:1:1:1", "**bcd", "bcd"),
    ("ab", "0-:1:1:1", "***", ""),
    ("abcdef", "1:1:0-:1:1", "*ab**ef", "abef"),
]


def walk(text, spec, mark, lead):
    tokens = spec.split(":")
    while tokens and tokens[-1] == "":
        tokens.pop()
    waiting = []
    seen_stretch = False
    for i, token in enumerate(tokens):
        bare = token in {"0", "1"}
        waiting.append((len(text) - len(tokens) + i if bare and seen_stretch else i, token))
        seen_stretch |= not bare
    out, keep = lead, False
    for i, char in enumerate(text):
        if waiting and waiting[0][0] == i:
            keep = waiting.pop(0)[1] in {"1", "1-"}
        out += char if keep else mark
    return out


@pytest.mark.parametrize("text,spec,masked,deleted", VECTORS)
def test_walk_agrees_with_vectors(text, spec, masked, deleted):
    assert walk(text, spec, "*", "*") == masked
    assert walk(text, spec, "", "") == deleted


def test_vectors(spark):
    for spec in {v[1] for v in VECTORS}:
        rows = [v for v in VECTORS if v[1] == spec]
        got = (
            spark.createDataFrame([(v[0],) for v in rows], "t string")
            .select("t", span_mask(F.col("t"), spec), part_delete(F.col("t"), spec))
            .collect()
        )
        assert sorted(map(tuple, got)) == sorted((v[0], v[2], v[3]) for v in rows)


def test_every_short_spec_on_every_length(spark):
    tokens = ["0", "1", "0-", "1-", "", "x"]
    specs = [":".join(p) for k in (1, 2) for p in itertools.product(tokens, repeat=k)]
    longer = [":".join(p) for k in (3, 4) for p in itertools.product(tokens, repeat=k)]
    specs += random.Random(7).sample(longer, 120)
    specs += ["1:0:1:0:1-:0:1:0", "0-:1:1-:1:0-:1", "1:1:1:1:1:1:0-", "0-:1:0-:1:1-:0:0"]
    texts = ["abcdefghijklmn"[:n] for n in range(13)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for start in range(0, len(specs), 60):
        chunk = specs[start : start + 60]
        got = df.select(
            "t",
            F.array(*[span_mask(F.col("t"), s) for s in chunk]).alias("m"),
            F.array(*[part_delete(F.col("t"), s) for s in chunk]).alias("d"),
        ).collect()
        for row in got:
            assert row.m == [walk(row.t, s, "*", "*") for s in chunk]
            assert row.d == [walk(row.t, s, "", "") for s in chunk]


def test_null_stays_null_and_numbers_are_text(spark):
    df = spark.createDataFrame([(None, 12345), ("abc", None)], "t string, n long")
    got = df.select(
        span_mask(F.col("t"), "1:0-:1"), part_delete(F.col("t"), "0-"), span_mask(F.col("n"), "1:0-")
    ).collect()
    assert [tuple(r) for r in got] == [(None, None, "*1****"), ("*a*c", "", None)]
