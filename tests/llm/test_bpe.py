"""Byte-pair encoding against the tokenizers library."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from veilframe.llm import bpe
from veilframe.llm.arrays import PrimeHash, mix, seeded
from veilframe.llm.queries import QUERIES, tokenizer_file

from .conftest import FOLDER

TOKENIZER = Tokenizer.from_file(tokenizer_file())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_word_rule_is_the_tokenizers():
    rule, kinds = bpe._tokenizer(open(tokenizer_file(), encoding="utf-8").read())
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choice("ab1é's t\n\t'mlvred!. ß٣漢  ") for _ in range(draw.randint(1, 24)))
        starts = [span[0] for _, span in rule.pre_tokenizer.pre_tokenize_str(text)]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        assert bpe.word_starts(points, kinds).tolist() == starts, text


def test_edge_cases(stored_docs):
    texts = [None, "", " ", "\n\n", "it's  she'll 'twas", "a<|endoftext|>b", "!<|endoftext|>", " <|endoftext|> ",
             "\x00́🙂 日本語", "same", "same", "x" * 300_000, "word " * 50_000]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)]
    got = bpe.encode_decode(stored_docs(rows), tokenizer_file()).collect()
    assert len(got) == len(rows)
    wanted = sorted((t or "", ids_of(t)) for _, t in rows)
    assert sorted((r.decoded, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == wanted
    assert [r.doc_id for r in got].count(None) == 1


def test_empty_table_and_few_rows(stored_docs, spark):
    assert bpe.encode_decode(stored_docs([]), tokenizer_file()).count() == 0
    back = bpe.decode(bpe.encode_decode(stored_docs([(1, "a b"), (2, None)]), tokenizer_file()), tokenizer_file(), into="again")
    assert sorted(r.again for r in back.collect()) == ["", "a b"]


def test_query_on_the_whole_table(spark, documents):
    import hashlib

    got = QUERIES["op2_bpe_word_table"](spark, FOLDER).collect()
    assert len(got) == len(documents)
    for r in got:
        ids = ids_of(documents[r.doc_id])
        decoded = TOKENIZER.decode(ids, skip_special_tokens=False).encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded).hexdigest()


def test_different_readings_are_an_error(spark):
    from pyspark.sql import functions as F

    other = F.udf(lambda i: f"{i} {random.SystemRandom().random()}", "string").asNondeterministic()
    unstable = spark.range(2000).select(F.col("id").alias("doc_id"), other("id").alias("text"))
    with pytest.raises(Exception, match="store them first|decode to their text"):
        bpe.encode_decode(unstable, tokenizer_file()).collect()


class Weak:
    """Hashes by which many words meet."""

    def sums(self, points):
        return points

    def spans(self, sums, starts, ends):
        return ((ends - starts) % 3).astype(np.uint64)


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    rule, kinds = bpe._tokenizer(open(tokenizer_file(), encoding="utf-8").read())
    monkeypatch.setattr(bpe, "prime_hash", lambda *_: Weak())
    draw = random.Random(6)
    texts = [" ".join(draw.choice(["one", "two", "ab", "é🙂", "three", "x", "abcd", "ba"]) for _ in range(9)) for _ in range(40)]
    words = bpe.Words(kinds, {})
    for i in range(0, 40, 8):
        words.add(pa.array(range(8)), [*texts[i : i + 7], None])
    found, hashes, codes = words.finish()
    assert len(found) == len(set(found)) == len(hashes) and len(set(hashes.tolist())) <= 3
    at = 0
    for i, count in enumerate(words.counts):
        text = "".join(found[c] for c in codes[at : at + count])
        assert text == ("" if i % 8 == 7 else texts[i])
        at += count


def test_words_that_meet_modulo_powers_of_two(stored_docs):
    rows = []
    for n in (512, 1024, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        rows += [(n, word), (n + 1, word.translate({97: 98, 98: 97}))]
    got = {r.doc_id: r for r in bpe.encode_decode(stored_docs(rows), tokenizer_file()).collect()}
    for key, text in rows:
        assert np.frombuffer(got[key].ids, "<u4").tolist() == ids_of(text) and got[key].decoded == text


def test_a_block_is_held_in_few_times_its_size():
    rule = bpe._rule(open(tokenizer_file(), encoding="utf-8").read())
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(20_000)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(1600)]
    rows = pa.record_batch([pa.array(range(1600)), pa.array(texts)], ["key", "text"])
    block = sum(map(len, texts))
    assert 3 << 20 < block < bpe.BLOCK_BYTES
    list(bpe._blocks([rows.slice(0, 9)], "key", "text", rule, {}, 0))
    tracemalloc.start()
    try:
        (number, content), = bpe._blocks([rows], "key", "text", rule, {}, 0)
        found, hashes, codes = content.finish()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert "".join(found[c] for c in codes) == "".join(texts) and len(set(found)) == len(found) == len(hashes)
    # Texts, words, their numbers and bounds; it was 17 times with hashes of all positions and of all code points.
    assert peak < 9 * block


def test_words_are_cut_without_the_vocabulary():
    whole = open(tokenizer_file(), encoding="utf-8").read()
    rule = bpe._rule(whole)
    assert len(rule) < 2000 and Tokenizer.from_str(rule).get_vocab_size() == 0
    text = "It's  a 12% ß漢 test\n\n ok!"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    found = [bpe.word_starts(points, bpe._tokenizer(of)[1]).tolist() for of in (rule, whole)]
    assert found[0] == found[1] == [a for _, (a, _) in TOKENIZER.pre_tokenizer.pre_tokenize_str(text)]


def test_hash_values_are_made_for_symbols_that_occur():
    spans = PrimeHash(2)
    low, high = np.array([97, 98], np.uint32), np.array([97, 0x10FFFF], np.uint32)
    before = spans.sums(low)
    assert len(spans.values) == 256
    sums = spans.sums(high)
    assert len(spans.values) == 0x110000 and (spans.sums(low) == before).all()
    wanted = mix(np.array([0x10FFFF], np.uint64) + seeded(3)) % np.uint64((1 << 61) - 2) + np.uint64(1)
    assert spans.values[0x10FFFF] == wanted[0] and sums[1] == before[1]


def test_results_that_go_out_in_pieces_are_whole(monkeypatch, stored_docs):
    monkeypatch.setattr(bpe, "OUT_PIECE", 50)
    rows = [(None if i == 3 else i, "word " * (i % 7) or None) for i in range(60)] + [(99, "x" * 300)]
    got = bpe.encode_decode(stored_docs(rows, parts=1), tokenizer_file()).collect()
    assert sorted((r.decoded, str(r.doc_id)) for r in got) == sorted((t or "", str(k)) for k, t in rows)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == ids_of(r.decoded) for r in got)
