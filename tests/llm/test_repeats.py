"""Removal of repeated strings against a table of all strings."""

import os
import random

import pytest

from veilframe.llm.repeats import COVERS, remove_repeats
from veilframe.sources.tables import shared_folder


def brute(rows, n):
    low = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - n + 1 if key is not None else 0):
            s = data[i : i + n]
            low[s] = min(key, low.get(s, key))
    found = []
    for key, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - n + 1 if key is not None else 0):
            if low[data[i : i + n]] < key:
                covered[i : i + n] = b"\1" * n
        edges = [i for i in range(len(data) + 1) if bool(i < len(data) and covered[i]) != bool(i and covered[i - 1])]
        kept = bytes(c for c, gone in zip(data, covered) if not gone)
        found.append((key, len(data), list(zip(edges[::2], edges[1::2])), kept))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(
        ((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("period,cover", COVERS.items())
def test_covers_have_every_difference(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("length", [50, 8, 1])
def test_against_brute_force(stored_docs, length):
    draw = random.Random(length)
    parts = ["".join(draw.choice("abé ") for _ in range(draw.randint(1, 70))) for _ in range(12)]
    rows = [
        (draw.choice([None, -3, *range(40)]),
         draw.choice([None, "", "x" * 300, *["".join(draw.choice(parts) for _ in range(draw.randint(1, 8)))] * 6]))
        for _ in range(120)
    ]
    rows += [(50, "y" * 20_000), (51, "y" * 60), (51, "y" * 60), (52, parts[0] * 40)]
    assert rows_of(remove_repeats(stored_docs(rows, parts=6), length=length)) == brute(rows, length)


def test_copies_within_a_shard_and_across(stored_docs):
    text = "The same sixty bytes of text again and again in many places."
    rows = [(i, f"{i} {text} {i}") for i in range(200)]
    assert rows_of(remove_repeats(stored_docs(rows, parts=7))) == brute(rows, 50)


def test_empty_table(stored_docs):
    assert remove_repeats(stored_docs([])).count() == 0


def test_whole_copies_and_strings_that_stand_twice_in_a_text(stored_docs):
    line = "a line that stands in many documents, sometimes more than once each; "
    other = "another one of more than fifty bytes that only some of them have at all. "
    rows = [(i, f"{i * 7919} " + line * (1 + i % 4) + other * (i % 3) + f"{i} " + line * (i % 2)) for i in range(150)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 150, 3)] + [(-1, rows[7][1]), (None, rows[8][1]), (9, rows[9][1])]
    rows += [(2000 + i, "short copy") for i in range(5)] + [(3000 + i, "z" * 49) for i in range(3)]
    assert rows_of(remove_repeats(stored_docs(rows, parts=6))) == brute(rows, 50)
    docs = stored_docs(rows).withColumnsRenamed({"doc_id": "digest", "text": "removed"})
    got = remove_repeats(docs, key="digest", text="removed")
    assert got.columns == ["digest", "n_bytes", "removed", "kept"] and got.count() == len(rows)


def test_only_what_the_result_reads_stays_stored(spark, stored_docs):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    rows = [(i, f"{i} " + "the same text " * 9) for i in range(30)]
    assert remove_repeats(stored_docs(rows)).count() == 30
    # The shards, the whole copies and the reports of four buckets.
    assert len(set(os.listdir(folder)) - before) == 6
