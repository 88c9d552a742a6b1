"""Phrases by the positional index against plain scans."""

import os
import random
import re

import duckdb
import numpy as np
import pytest

from veilframe.llm.decontaminate import _terms, find_phrases
from veilframe.llm.queries import ORACLES, QUERIES
from veilframe.sources.tables import shared_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(None if item is None else str(item))
    found = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    names |= got
        found.append((key, len(w), len(hit), sorted(names, key=lambda n: (n is None, n or ""))))
    return sorted(found, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


ITEMS = [(1, "The quick brown fox"), (2, "a " * 20), (3, None), (4, "..."), (None, "no item"), (5, "the Quick brown fox"),
         (6, " ".join(f"w{i}" for i in range(30))), (10, "É é, Straße!")]


def docs():
    draw = random.Random(3)
    vocabulary = ["the", "QUICK", "brown", "fox", "a", "w0", "w1", "é", "É", "straße", "-", "x"]
    out = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60)))) for i in range(150)]
    out += [(500, None), (None, "the quick brown fox"), (501, ""), (502, ITEMS[5][1] and " ".join(f"W{i}" for i in range(5, 25))),
            (503, "the quick"), (504, "brown fox"), (505, "the quick brown fox " * 5000), (500, "É é straße"), (505, "x")]
    return out


def test_exact_phrases(stored_docs):
    items = stored_docs(ITEMS, "item_id long, text string")
    assert rows(find_phrases(stored_docs(docs()), items)) == brute(docs(), ITEMS)


def test_blocks_of_items_give_the_same(stored_docs, monkeypatch):
    monkeypatch.setattr("veilframe.llm.decontaminate.BLOCK_BYTES", 30)
    items = stored_docs(ITEMS, "item_id long, text string")
    assert rows(find_phrases(stored_docs(docs()), items)) == brute(docs(), ITEMS)


def test_proximity(stored_docs):
    items = stored_docs([(1, "one two three four")], "item_id long, text string")
    near = stored_docs([(1, "one two three four"), (2, "one two of three four"), (3, "four x x x x one x x x two"),
                        (4, "one two x x x x three four")])
    got = {r.doc_id: (r.n_hit, list(r.near_items)) for r in find_phrases(near, items, slop=1).collect()}
    assert got == {1: (4, ["1"]), 2: (0, ["1"]), 3: (0, []), 4: (0, [])}
    with pytest.raises(ValueError):
        find_phrases(near, items, width=60, slop=10)


def test_empty_tables(stored_docs):
    none = stored_docs([], "item_id long, text string")
    assert rows(find_phrases(stored_docs([(1, "a b")]), none)) == [(1, 2, 0, [])]
    assert find_phrases(stored_docs([]), stored_docs(ITEMS, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [1 << 20, 30])
def test_items_without_an_id_count(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr("veilframe.llm.decontaminate.BLOCK_BYTES", size)
    items = [*ITEMS, (None, "brown fox"), (None, "x x x"), (None, None), (None, " ".join(f"v{i}" for i in range(20)))]
    more = [(600, "no item"), (601, " ".join(f"V{i}" for i in range(2, 18))), (602, "the quick brown fox x x x")]
    spark.createDataFrame([*docs(), *more], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = [tuple(r) for r in QUERIES["op3_decontaminate_index"](spark, str(tmp_path)).collect()]
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
        assert sorted(found, key=repr) == sorted(db.sql(ORACLES["op3_decontaminate_index"]).fetchall(), key=repr)
    by_key = {r[0]: r for r in found}
    assert by_key[600][2:4] == (2, 1) and by_key[601][2:4] == (16, 1) and by_key[602][2:4] == (7, 3)
    ids = find_phrases(*(spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("documents", "benchmark")))
    assert {r.doc_id: r["items"] for r in ids.collect()}[602] == ["1", "5", None]


def test_words_of_equal_hash_are_told_apart():
    texts = [draw for draw in ["ab", "cd", "ab", "abc", "cd", "x", "ab", "zz", "x"]]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    at = ends - [len(t) for t in texts]
    for hashes in ([7] * 9, [len(t) for t in texts], [ord(t[0]) for t in texts], list(range(9))):
        if len(set(hashes)) == 9:
            continue
        term, spelled = _terms(data, at, ends, np.array(hashes, np.uint64))
        assert [texts[spelled[t]] for t in term] == texts
        assert len(spelled) == len({(h, t) for h, t in zip(hashes, texts)})


def test_a_full_table_of_terms_and_words_beyond_it(stored_docs, monkeypatch):
    monkeypatch.setattr("veilframe.llm.decontaminate.TERM_BITS", 8)
    items = stored_docs(ITEMS, "item_id long, text string")
    assert rows(find_phrases(stored_docs(docs()), items)) == brute(docs(), ITEMS)


def test_only_what_the_result_reads_stays_stored(spark, stored_docs):
    folder = shared_folder(spark)
    items, texts = stored_docs(ITEMS, "item_id long, text string"), stored_docs(docs())
    before = set(os.listdir(folder))
    assert find_phrases(texts, items).count() == len(docs())
    assert len(set(os.listdir(folder)) - before) == 2
