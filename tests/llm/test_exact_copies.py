import hashlib
import re

import pytest
from pyspark.sql import functions as F

from veilframe.llm.exact_copies import LEAST, MOST, chunks_of, exact_copies


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(spaced(text), []).append(key)
    found = []
    for key, text in rows:
        keys = groups[spaced(text)]
        some = [k for k in keys if k is not None]
        digest = hashlib.sha256(spaced(text).encode()).hexdigest()
        found.append((key, min(some) if some else None, len(keys), digest))
    return sorted(found, key=repr)


def word(i):
    return hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 9]


LONG = "".join(f"word{i}, " + ("x" * (i % 40)) for i in range(20_000))
ROWS = [
    (9, None), (4, ""), (7, " "), (8, "\t\r\n"), (1, "a b"), (2, "a \n b"), (3, "a  b "), (5, "a b "),
    (6, "a b"), (10, "é🙂 x"), (11, "é🙂\tx"), (None, "nobody"), (None, "nobody"), (12, "nobody"),
    (13, LONG), (14, LONG.replace(" ", "\n ")), (15, LONG + "."), (16, "y" * 50_000), (17, "y" * 50_000),
    (18, "y" * 49_999), (20, "same"), (20, "same"), (20, "same"), (21, "other"), (None, None),
    *[(100 + i, "hot copy, of a text") for i in range(300)],
]


@pytest.mark.parametrize("fingerprint", [F.xxhash64, lambda c: F.length(c).cast("long") % 3])
def test_copies(spark, stored_docs, fingerprint):
    docs = stored_docs(ROWS)
    got = exact_copies(docs, fingerprint=fingerprint)
    assert got.columns == ["doc_id", "keep", "size", "kept", "digest"]
    rows = got.collect()
    assert sorted([(r.doc_id, r.keep, r["size"], r.digest) for r in rows], key=repr) == brute(ROWS)
    kept = [(r.doc_id, r.digest) for r in rows if r.kept]
    assert len(kept) == len({d for _, d in kept}) == len({spaced(t) for _, t in ROWS})
    assert all(r.doc_id == r.keep for r in rows if r.kept)


def test_a_hot_group_is_dealt_out(spark, stored_docs):
    rows = [(i, "hot") for i in range(4000)] + [(4000 + i, f"cold {i}") for i in range(2000)]
    got = exact_copies(stored_docs(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "piece" in plan and "Python" not in plan and "Arrow" not in plan
    assert got.filter("doc_id < 4000").agg(F.sum("size"), F.count_if("kept"), F.max("keep")).first()[:] == (16_000_000, 1, 0)
    assert got.filter("doc_id >= 4000 and kept and size = 1 and keep = doc_id").count() == 2000


def test_names_that_clash_and_empty_tables(spark, stored_docs):
    docs = stored_docs([(1, "a"), (2, "a")])
    for name in ("recipe", "digest", "first", "size", "piece", "pieces", "print", "chunk", "keep", "kept"):
        docs = docs.withColumn(name, F.lit("mine"))
    assert sorted(r[:4] for r in exact_copies(docs).collect()) == [(1, 1, 2, True), (2, 1, 2, False)]
    assert exact_copies(docs.limit(0)).collect() == []
    renamed = docs.select(F.col("doc_id").alias("a.b"), F.col("text").alias("row"))
    assert exact_copies(renamed, key="a.b", text="row").count() == 2


def test_chunks_are_the_text_and_depend_on_content(spark):
    text = "".join(f"{word(i)} number {i} {word(7 * i)} ends. " for i in range(4000))
    df = spark.createDataFrame([(text,), ("A new first sentence, " + text,), ("z" * 30_000,), ("",)], "text string")
    rows = [r[0] for r in df.select(chunks_of(F.col("text"))).collect()]
    assert ["".join(r) for r in rows] == [r.text for r in df.collect()]
    assert all(len(c) <= MOST for r in rows for c in r) and all(len(c) >= LEAST for c in rows[0][:-1])
    assert len(set(rows[0]) & set(rows[1])) > 0.8 * len(rows[0])


def test_query_on_the_whole_table(spark, documents):
    from veilframe.llm.queries import QUERIES

    from .conftest import FOLDER

    got = QUERIES["op11_chunk_recipes"](spark, FOLDER)
    assert got.dtypes == [("doc_id", "bigint"), ("keep_id", "bigint"), ("group_size", "bigint"),
                          ("kept", "boolean"), ("text_sha256", "string")]
    rows = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()]
    assert sorted(rows, key=repr) == brute(list(documents.items()))
