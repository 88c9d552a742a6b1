"""Policies and link specs kept as UTF-8 JSON files, on any file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

from veilframe.plans import LinkSpec, Policy


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).head()[0]


def read_policy(spark: SparkSession, path: str) -> Policy:
    return Policy.from_json(_text(spark, path))


def read_link_spec(spark: SparkSession, path: str, **options) -> LinkSpec:
    return LinkSpec.from_json(_text(spark, path), **options)


def read_secret(spark: SparkSession, path: str) -> bytes:
    """The bytes of a file, all of them: a line feed at the end is part of the secret."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0])
