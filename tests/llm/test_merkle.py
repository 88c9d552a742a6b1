import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from veilframe.llm.merkle import fold, manifest, siblings

from .conftest import FOLDER

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(cells):
    texts = [None if c is None else str(c) for c in cells]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(nodes):
    """All levels, and of each first node its siblings with the side they stand on."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([sha("".join(n[i : i + 2])) for i in range(0, len(n), 2)])
    return levels


def path(levels, i):
    steps = []
    for level in levels[:-1]:
        beside = level[i ^ 1] if i ^ 1 < len(level) else ""
        steps.append((beside, "") if i % 2 else ("", beside))
        i //= 2
    return steps


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees, places = {}, {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in own])
        for i, r in enumerate(own):
            places.setdefault(r, []).append((lang, i))
    top = tree([trees[lang][-1][0] for lang in langs])
    found = []
    for r, at in places.items():
        for lang, i in at:
            steps = path(trees[lang], i) + path(top, langs.index(lang))
            tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf((*r[:3], r[3] + 1, r[4])) if tampered else leaf(r)
            for left, right in steps:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in steps))
            root = top[-1][0]
            found.append((r[0], leaf(r), trees[lang][-1][0], root, proof, node, node == root))
            assert (node == root) != tampered
    return sorted(found, key=repr)


def applied(docs, block):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest(docs, block=block, changed={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    root = fold(F.col("changed_leaf"), F.col("proof"))
    rows = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256), root, root == F.col("root"))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


ROWS = [(i, f"s{i % 3}", ("en", "de", "fr", "été", "")[min(i % 11, 4)], i, f"text {i} é") for i in range(150)]
ROWS += [(1000 + i, None, None, None, None) for i in range(5)]
ROWS += [(5, "s", "en", 3, "same key"), (6, "s", "en", 4, "again"), (None, "s", "en", 4, "no key"), (7, "", "lone", 0, "")]
ROWS += [(8, "twice", "en", 1, "twice")] * 3 + [(9, "long", "en", 400_000, "ab" * 200_000)]


@pytest.mark.parametrize("block", [4, 1024])
def test_against_a_plain_tree(spark, stored_docs, block):
    assert applied(stored_docs(ROWS, SCHEMA), block) == brute(ROWS)


def test_sizes_around_the_blocks(spark):
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65]
    rows = [(1000 * n + i, "s", f"of {n:03}", i, "t") for n in sizes for i in range(n)]
    assert applied(spark.createDataFrame(rows, SCHEMA), 4) == brute(rows)


@pytest.mark.parametrize("count", [1, 16])
def test_a_single_group(spark, count):
    rows = [(i, "s", "en", i, "t") for i in range(count)]
    assert applied(spark.createDataFrame(rows, SCHEMA), 4) == brute(rows)


def test_empty_tables_clashing_names_and_other_columns(spark, stored_docs):
    docs = stored_docs(ROWS[:40], SCHEMA)
    for name in ("group", "order", "node", "other", "place", "own", "proof", "root", "at", "part", "level_0", "members"):
        docs = docs.withColumn(name, F.lit("mine"))
    assert applied(docs, 4) == brute(ROWS[:40])
    assert manifest(docs.limit(0)).collect() == []
    named = docs.selectExpr("doc_id AS `a.b`", "lang AS own", "text")
    found = manifest(named, columns=["text", "a.b"], group="own", order="a.b")
    assert found.columns[:2] == ["a.b", "own"] and found.count() == 40
    assert {r.own for r in found.collect()} == {r[2] for r in ROWS[:40]}


def test_query_on_the_whole_table(spark):
    from veilframe.llm.queries import QUERIES

    got = QUERIES["op13_merkle_manifest"](spark, FOLDER)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "string") for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                          ("verified", "boolean")]
    rows = duckdb.sql(f"SELECT doc_id, source, lang, n_chars, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
