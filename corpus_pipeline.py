"""Clean a corpus: language, near copies, benchmark passages, personal data, tokens.

Every stage takes the documents that the one before has stored and returns
documents with the columns that they had; the last returns their tokens. Stages
drop rows by decision only: rows with NULL keys, copies of rows and columns of
any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import free_name, named
from veilframe.llm import bpe, decontaminate, language, near_copies, pii
from veilframe.llm.arrays import if_short, small_batches
from veilframe.llm.queries import tokenizer_file
from veilframe.sources import materialize, scratch

# Below this fit to the learned languages a document is mostly in others, or a jumble.
LEAST_FIT = 0.5
# Bytes of texts that a task is sent at a time, or one text; all stages share an executor's memory.
BATCH = "1m"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly in languages learned from them, in one or several.

    Texts that are NULL, empty or without a letter go.
    """
    small_batches(spark, BATCH)
    model = language.train(docs)
    names = [free_name(name, docs) for name in ("pred", "score", "spans", "fit")]
    found = language.identify(docs, model, "text", 8.0, *names)
    known = (F.col(names[0]) != language.UNKNOWN) & (F.col(names[3]) >= LEAST_FIT)
    return found.filter(known).select(*map(named, docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest key, the first of those in the table."""
    small_batches(spark, BATCH)
    return near_copies.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth."""
    small_batches(spark, BATCH)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = free_name("row", docs)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    with scratch(spark):
        found = decontaminate.find_phrases(numbered, items, key=row)
        bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
        bad = materialize(found.filter(bad).select(row), keep=True)
    return numbered.join(if_short(bad), row, "left_anti").drop(row)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind in place of each piece of personal data."""
    small_batches(spark, BATCH)
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast("long"))
    return clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256)``; ids are unsigned 32-bit integers, little-endian."""
    small_batches(spark, BATCH)
    found = bpe.encode_decode(docs, tokenizer_file())
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near copies", keep_one_of_near_copies),
    ("benchmark passages", drop_contaminated),
    ("personal data", hide_personal_data),
    ("tokens", encode),
]

# Language models, signatures and tokens are beyond SQL; tests/llm/test_pipeline.py compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``.

    What a stage stores on its way goes when it ends, and its result when the
    others have been run. The input of the last stage stays for its readers;
    personal data is hidden in it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *others, (_, hide), (_, last) = STAGES
    with scratch(spark):
        for _, stage in others:
            with scratch(spark):
                docs = materialize(stage(spark, docs, sf_dir), keep=True)
        docs = materialize(hide(spark, docs, sf_dir), keep=True)
    return last(spark, docs, sf_dir)
