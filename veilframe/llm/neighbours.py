"""Nearest neighbours by inner product with cross-polytope hashing.

A table of the index rotates every vector by three rounds of random signs and
a Hadamard transform, and files it under the signed axis that its rotation is
closest to. A query looks into the buckets of its few closest axes in every
table. Candidates are joined to queries by bucket and ranked by the exact
product. Buckets grow with the table: vectors without close neighbours are found
only where a query meets a large share of all rows, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.sources import materialize


def usable(vector: str) -> Column:
    """Whether a vector can take part: not NULL, not empty, all components finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        F.col(vector).isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, finite)
        & F.exists(vector, lambda x: x != 0)
    )


def signs(dimension: int, tables: int, functions: int, seed: int) -> np.ndarray:
    drawn = np.random.default_rng(seed).integers(0, 2, (tables, functions, 3, dimension))
    return 2.0 * drawn - 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; its width is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, flips: np.ndarray) -> np.ndarray:
    for flip in flips:
        x = hadamard(x * flip)
    return x


def closest_axes(x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the ``probes`` closest signed axes, best first, and their products."""
    both = np.concatenate([x, -x], axis=1)
    probes = min(probes, both.shape[1])
    top = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    value = np.take_along_axis(both, top, axis=1)
    order = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)


def buckets(x: np.ndarray, flips: np.ndarray, probes: int) -> list[np.ndarray]:
    """For each table the ``probes`` best buckets of every row; the first is the row's own."""
    return [closest_axes(rotated(x, function), probes)[0] for table in flips for function in table]


def nearest(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    every: int = 20,
    tables: int = 12,
    probes: int = 12,
    occupancy: int = 4096,
    seed: int = 1,
) -> DataFrame:
    """``(query, rank, key, score)``: the ``k`` nearest found of every ``every``-th row.

    Queries are the rows whose key ``every`` divides; candidates are all rows
    but those of the query's own key. ``score`` is the inner product of the
    vectors as they are, in double precision, and ties go to the smaller key. A
    row without a key or without a usable vector takes no part, and vectors of
    different lengths never meet. A repeated row counts once; a key with
    several vectors is found, and asks, with each of them, and a pair of keys
    counts with its best product. Other columns are not read.

    Equal vectors are filed once, with the ``k + 1`` smallest of their keys: no
    query can return more of them. Where lengths differ, one more component
    takes up what a vector lacks to the longest, which leaves the order of
    products as it is and makes it an order of angles. Buckets with more than
    ``occupancy`` vectors are searched in pieces of about that size; the size of
    the table changes no bucket. A query for which the buckets hold fewer than
    ``k`` keys is searched against all rows instead.
    """
    spark = vectors.sparkSession
    base = vectors.filter(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("v")
    )
    kind = base.schema["v"].dataType.simpleString()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    order = Window.partitionBy("v").orderBy("id")
    smallest = base.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    filed = materialize(
        smallest.groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select("v", "ids", norm.alias("norm"), F.size("v").alias("size"))
    )
    facts = filed.groupBy("size").agg(F.count("*").alias("n"), F.max("norm").alias("high"), F.min("norm").alias("low"))
    plans, total = {}, 0
    for row in facts.collect():
        total += row["n"]
        longer = row["high"] - row["low"] > 1e-6 * row["high"]
        width = 1 << max(row["size"] + longer - 1, 1).bit_length()
        plans[row["size"]] = (width, row["high"] if longer else None, signs(width, tables, 1, seed))
    shared = spark.sparkContext.broadcast(plans)
    asking = base.filter(F.col("id") % every == 0).distinct()

    index = filed.mapInArrow(_filing(shared, 1, False), f"size int, place int, bucket long, v {kind}, ids array<long>")
    asked = asking.withColumn("ids", F.array("id")).withColumn("norm", norm).withColumn("size", F.size("v"))
    asked = asked.select("v", "ids", "norm", "size").mapInArrow(
        _filing(shared, probes, True), f"size int, place int, bucket long, v {kind}, ids array<long>"
    )
    where = ["size", "place", "bucket"]
    pieces = index.groupBy(*where).agg(F.ceil(F.count("*") / occupancy).alias("pieces"))
    pieces = materialize(pieces)
    index = index.join(pieces, where).withColumn("piece", F.pmod(F.xxhash64("ids"), "pieces")).drop("pieces")
    asked = asked.join(pieces, where).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    ).drop("pieces")
    found = _met(index, asked, [*where, "piece"], k)
    merged = materialize(_merged(found, k))

    # Queries that found too few, against all rows in blocks.
    blocks = max(1, -(-total // occupancy))
    short = asking.join(merged.filter(F.size("best") >= k), F.col("id") == F.col("query"), "left_anti")
    short = short.select(
        F.size("v").alias("size"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("piece"),
        "v",
        F.array("id").alias("ids"),
    )
    everything = filed.select("size", F.pmod(F.xxhash64("ids"), F.lit(blocks)).cast("int").alias("piece"), "v", "ids")
    rest = _merged(_met(everything, short, ["size", "piece"], k), k)
    best = merged.filter(F.size("best") >= k).unionByName(rest)
    return best.select("query", F.posexplode("best").alias("rank", "b")).select(
        "query",
        (F.col("rank") + 1).alias("rank"),
        F.col("b.id").alias(key),
        (-F.col("b.far")).alias("score"),
    )


def _filing(shared, probes: int, asking: bool):
    """Rows with their vector's buckets in every table, in tasks of bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("size").to_pylist())
            for size, (width, high, flips) in shared.value.items():
                mine = np.flatnonzero(sizes == size)
                for part in np.array_split(mine, -(-len(mine) // 1024)) if len(mine) else ():
                    rows = batch.take(pa.array(part))
                    x = np.array(rows.column("v").flatten().to_numpy(), np.float64).reshape(len(part), size)
                    norm = rows.column("norm").to_numpy()
                    padded = np.zeros((len(part), width))
                    if high is None or asking:
                        padded[:, :size] = x / norm[:, None]
                    else:
                        padded[:, :size] = x / high
                        padded[:, size] = np.sqrt(np.maximum(0, 1 - (norm / high) ** 2))
                    for place, codes in enumerate(buckets(padded, flips, probes)):
                        times = codes.shape[1]
                        again = rows.take(pa.array(np.repeat(np.arange(len(part)), times)))
                        n = len(part) * times
                        yield pa.record_batch(
                            [
                                pa.array(np.full(n, size), pa.int32()),
                                pa.array(np.full(n, place), pa.int32()),
                                pa.array(codes.reshape(-1).astype(np.int64)),
                                again.column("v"),
                                again.column("ids"),
                            ],
                            ["size", "place", "bucket", "v", "ids"],
                        )

    return run


BEST = "array<struct<far:double,id:long>>"
BEST_TYPE = pa.list_(pa.struct([("far", pa.float64()), ("id", pa.int64())]))


def _met(index: DataFrame, asked: DataFrame, by: list[str], k: int) -> DataFrame:
    """For each query and group the ``k`` nearest keys there, as ``(minus score, key)``."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names, best = [], []
        if rows.num_rows and queries.num_rows:
            ids = rows.column("ids").to_pylist()
            x = np.stack([np.array(v, np.float64) for v in rows.column("v").to_pylist()])
            n = len(x)
            # A row for each key of a vector, the rows of a key together.
            filed = np.array([i for some in ids for i in some], np.int64)
            order = np.argsort(filed, kind="stable")
            x, filed = x[np.repeat(np.arange(n), [len(some) for some in ids])[order]], filed[order]
            keys, firsts = np.unique(filed, return_index=True)
            q = np.stack([np.array(v, np.float64) for v in queries.column("v").to_pylist()])
            own = np.array([i[0] for i in queries.column("ids").to_pylist()], np.int64)
            step = max(1, 256 * n // len(x))
            for start in range(0, len(q), step):
                products = q[start : start + step] @ x.T
                asking = own[start : start + step]
                # The best of each key but the query's own.
                each = products.copy() if len(keys) == len(x) else np.maximum.reduceat(products, firsts, axis=1)
                at = np.minimum(np.searchsorted(keys, asking), len(keys) - 1)
                mine = np.flatnonzero(keys[at] == asking)
                each[mine, at[mine]] = -np.inf
                top = min(k, len(keys))
                edge = -np.partition(-each, top - 1, axis=1)[:, top - 1]
                for row, query in enumerate(asking.tolist()):
                    # Ties at the edge: all rows as near as the last of the nearest.
                    chosen = np.flatnonzero((products[row] >= edge[row] - 1e-9) & (filed != query))
                    exact = (q[start + row] * x[chosen]).cumsum(axis=1)[:, -1]
                    far: dict[int, float] = {}
                    for score, i in zip(exact.tolist(), filed[chosen].tolist()):
                        far[i] = min(-score, far.get(i, -score))
                    names.append(query)
                    best.append([{"far": a, "id": b} for a, b in sorted((a, b) for b, a in far.items())[:k]])
        return pa.table({"query": pa.array(names, pa.int64()), "best": pa.array(best, BEST_TYPE)})

    return index.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(run, f"query long, best {BEST}")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all groups; a query has a bounded number of them."""
    pairs = found.select("query", F.inline("best")).groupBy("query", "id").agg(F.min("far").alias("far"))
    order = Window.partitionBy("query").orderBy("far", "id")
    ranked = pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    return ranked.groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("far", "id"))).alias("best")
    )
