"""The stages of the corpus pipeline: who goes, who stays, and that columns are kept."""

import hashlib
import os
import struct

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from veilframe.llm.pii import spans_of
from veilframe.sources.tables import shared_folder

from .conftest import FOLDER
from .test_decontaminate import brute as phrases_by_hand
from .test_near_copies import classes

FOREIGN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "zh": "人人生而自由,在尊严和权利上一律平等。",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti.",
    "sv": "Alla människor är födda fria och lika i värde och rättigheter.",
}


def test_foreign_texts_go_and_clean_mixed_ones_stay(spark, stored_docs):
    learned = duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet'").fetchall()
    clean = dict(duckdb.sql(f"SELECT lang, min(text) FROM '{FOLDER}/documents.parquet' WHERE length(text) > 600 "
                            "AND text NOT LIKE '%|%' AND text NOT LIKE '%$%' GROUP BY lang").fetchall())
    mixed = "\n".join(text[:400] for text in clean.values())
    rows = [(10_000_000, mixed, None), (10_000_001, None, "en"), (10_000_002, "", None), (10_000_003, "123 ...", None)]
    foreign = [(20_000_000 + i, text * 3, None) for i, text in enumerate(FOREIGN.values())]
    half = clean["en"][:300] + " " + FOREIGN["ru"] * 20
    docs = stored_docs([*learned, *rows, *foreign, (20_000_100, half, None)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_known_languages(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 10_000_000 in got and max(got) == 10_000_000
    assert {key for key, text, _ in learned if text and len(text) > 100} <= got


# The columns of documents, and some with names that a stage might want for itself.
OWN = ("row", "row_", "__row", "pred", "__pred", "score", "spans", "fit", "__fit", "text_", "n_hit", "ids")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    found = duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet' ORDER BY doc_id LIMIT 160").fetchall()
    return [(key, text, lang, "s", len(text) if text else 0) for key, text, lang in found]


ITEM = "Which of the seven bridges does the old ferryman cross before noon on market days in spring"


def planted():
    """Copies, near copies, benchmark passages, personal data, foreign texts, NULLs and ties."""
    base = [r for r in texts() if r[1] and len(r[1]) > 900][:6]
    word = lambda t, i: " ".join([*t.split()[:i], "changed", *t.split()[i + 1 :]])
    key = iter(range(100_000, 200_000))
    rows = [(next(key), r[1], *r[2:]) for r in base[:3]] + [(next(key), word(r[1], 20), *r[2:]) for r in base]
    rows += [(base[3][0], base[3][1], *base[3][2:]), (None, base[4][1], *base[4][2:])]
    short = " ".join(base[5][1].split()[:40])
    rows += [(next(key), f"{short} {ITEM} {short}", "en", "s", 1), (next(key), ITEM, "en", "s", 1)]
    rows += [(next(key), f"{base[5][1]} {base[0][1]} {base[1][1]} {ITEM}", "en", "s", 1)]
    rows += [(next(key), f"{base[2][1]} Write to ann.lee@example.com or +49 30 1234567, from 10.1.2.3 please.", "en", None, None)]
    rows += [(next(key), t * 4, None, "s", 1) for t in FOREIGN.values()]
    rows += [(next(key), None, "en", "s", None), (next(key), "", "en", "s", 0), (next(key), "12 34", "en", "s", 5), (None, None, None, None, None)]
    return rows


@pytest.fixture
def docs(spark, tmp_path):
    df = spark.createDataFrame([*texts(), *planted()], SCHEMA).coalesce(1)
    for name in OWN:
        df = df.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce("doc_id", F.lit(-1))))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, ITEM), (2, "nothing of the kind"), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def rows_of(df):
    """``(doc_id, text)`` of all rows, whose other columns must be as they were."""
    found = df.collect()
    for r in found:
        assert all(r[name] == f"{name} of {-1 if r.doc_id is None else r.doc_id}" for name in OWN)
    return sorted(((r.doc_id, r.text) for r in found), key=repr)


def one_of_each(rows):
    """The first row with the smallest key of each class of near copies, in order of the table."""
    numbered = [(i, text) for i, (_, text) in enumerate(rows)]
    groups = {}
    for i, group in classes(numbered):
        groups.setdefault(group, []).append(i)
    first = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)
    return [rows[i] for i in sorted(min(members, key=first) for members in groups.values())]


def uncontaminated(rows):
    found = phrases_by_hand([(i, text) for i, (_, text) in enumerate(rows)], [(1, ITEM), (2, "nothing of the kind")])
    bad = {i for i, n, hit, _ in found if hit and 20 * hit >= n}
    return [row for i, row in enumerate(rows) if i not in bad]


def hidden(text):
    """Each character by itself: kept, within a span, or the first of one that follows no other."""
    if text is None:
        return None
    marks, out = sorted((a, b, k) for k, a, b in spans_of(text)), []
    reach = 0
    for i, c in enumerate(text):
        for a, b, kind in marks:
            if a == i and a >= reach:
                out.append(f"[{kind.upper()}]")
            if a == i:
                reach = max(reach, b)
        if i >= reach:
            out.append(c)
    return "".join(out)


def test_near_copies(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted(one_of_each(rows), key=repr) and kept.count() < len(rows) - 8


def test_benchmark_passages(spark, docs, tmp_path):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted(uncontaminated(rows), key=repr) and kept.count() == len(rows) - 2


def test_personal_data(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    clean = corpus_pipeline.hide_personal_data(spark, docs, "")
    assert sorted(clean.columns) == sorted(docs.columns)
    assert rows_of(clean) == sorted(((k, hidden(t)) for k, t in rows), key=repr)
    (text,) = [t for _, t in rows_of(clean) if t and "Write to" in t]
    assert "Write to [EMAIL] or [PHONE], from [IP] please." in text
    assert {r.n_chars == (len(r.text) if r.text is not None else None) for r in clean.collect()} == {True}


def test_language_keeps_columns(spark, docs):
    kept = corpus_pipeline.keep_known_languages(spark, docs, "")
    assert kept.columns == docs.columns
    gone = {r.text for r in docs.select("text").collect()} - {text for _, text in rows_of(kept)}
    assert gone == {t * 4 for t in FOREIGN.values()} | {None, "", "12 34"}


def test_all_stages(spark, docs, tmp_path):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    foreign = {t * 4 for t in FOREIGN.values()} | {None, "", "12 34"}
    rows = uncontaminated(one_of_each([r for r in rows if r[1] not in foreign]))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    wanted = []
    for key, text in rows:
        ids = tokenizer.encode(hidden(text), add_special_tokens=False).ids
        data = struct.pack(f"<{len(ids)}I", *ids)
        wanted.append((key, len(ids), data, hashlib.sha256(data).hexdigest()))
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)
    # Nothing in clear is left: only the input of the last stage is still there.
    (left,) = set(os.listdir(folder)) - before
    assert spark.read.parquet(f"{folder}/{left}").filter("text LIKE '%ann.lee@%'").count() == 0


def test_empty_tables(spark, docs, tmp_path):
    folder = str(tmp_path / "empty")
    docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids", "ids_sha256"] and got.count() == 0
