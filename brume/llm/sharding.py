"""Uniform shuffle of rows into shards of exact size, by a hypergeometric communication matrix.

How many rows each input partition sends to each shard is drawn at once from the law that a uniform shuffle gives:
row by row of the matrix, multivariate hypergeometric in the room that the shards have left, by exact two-way draws. Each partition then
permutes its own rows and deals them out by its counts, the rows are exchanged, and each shard orders what it got by a
random 64-bit key. The result is a uniform permutation whose shards differ by one row at most.

The driver sees one count per partition and the matrix (partitions x shards), never a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, text_or_empty


def partition_counts(docs: DataFrame) -> dict[int, int]:
    rows = docs.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()
    return {r["p"]: r["n"] for r in rows}


def _log_chance(x: int, n: int, p: float) -> float:
    """Log of the binomial chance of x in n, by the saddle-point expansion: precise however large the numbers are."""

    def rest(n: int) -> float:  # log n! less Stirling's formula
        if n < 16:
            return math.lgamma(n + 1) - (n + 0.5) * math.log(n or 1) + n - 0.5 * math.log(2 * math.pi)
        return (1 / 12 - (1 / 360 - 1 / 1260 / n / n) / n / n) / n

    def deviance(x: int, mean: float) -> float:  # x log(x / mean) + mean - x
        v = (x - mean) / (x + mean)
        if abs(v) > 0.1:
            return x * math.log(x / mean) + mean - x
        total, term, k = (x - mean) * v, 2 * x * v, 1
        while True:
            term *= v * v
            k += 2
            if total + term / k == total:
                return total
            total += term / k

    if x == 0:
        return n * math.log1p(-p)
    if x == n:
        return n * math.log(p)
    return rest(n) - rest(x) - rest(n - x) - deviance(x, n * p) - deviance(n - x, n * (1 - p)) + 0.5 * math.log(n / (2 * math.pi * x * (n - x)))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n rows drawn without replacement are among the good ones; for numbers of any size.

    A few rows are drawn one by one, more by ratio of uniforms around the mode.
    """
    if n > (good + bad) // 2:
        return good - hypergeometric(rng, good, bad, good + bad - n)
    if n <= 12:
        found = 0
        for k in range(n):
            found += int(rng.integers(good + bad - k)) < good - found
        return found
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total, p = good + bad, n / (good + bad)
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    log_f = lambda x: _log_chance(x, good, p) + _log_chance(n - x, bad, p)
    top = log_f(mode)
    share = good / total
    spread = math.sqrt((total - n) / max(1, total - 1) * n * share * (1 - share) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u = 1 - rng.random()
        x = math.floor(n * share + 0.5 + width * (rng.random() - 0.5) / u)
        if low <= x <= high and 2 * math.log(u) <= log_f(x) - top:
            return x


def _dealt(rng: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    """n rows dealt at random to places of which each shard has `room`: by two-way draws between halves of the shards."""
    if len(room) == 1:
        return np.array([n], np.int64)
    half = len(room) // 2
    left = hypergeometric(rng, int(room[:half].sum()), int(room[half:].sum()), n)
    return np.concatenate([_dealt(rng, room[:half], left), _dealt(rng, room[half:], n - left)])


def communication_matrix(counts: dict[int, int], shards: int, seed: int) -> dict[int, np.ndarray]:
    """Rows sent by each partition to each shard: margins are the partition counts and near-equal shard sizes."""
    rng = np.random.default_rng(seed)
    total = sum(counts.values())
    room = np.full(shards, total // shards, np.int64)
    room[rng.permutation(shards)[: total % shards]] += 1
    matrix = {}
    for p in sorted(counts):
        matrix[p] = _dealt(rng, room, counts[p])
        room -= matrix[p]
    return matrix


def shuffle_into_shards(docs: DataFrame, *, shards: int = 24, seed: int = 20, rows_per_block: int = 65_536) -> DataFrame:
    """All rows and columns of `docs`, with `_shard` (0 to shards - 1) and `_slot` (gapless from 0 in each shard).

    Input columns of these two names go.

    Nulls, repeated rows and empty texts are rows like any other; an empty table stays empty. `docs` must give the same
    partitions when it is computed again, as a scan or a checkpoint does; a partition that has grown or shrunk raises an error.
    A shard of more than `rows_per_block` rows is ordered in blocks, by ranges of the random key, so no task holds it
    whole.
    """
    docs = docs.drop("_shard", "_slot")
    key_name, block_name, within_name, first_name = (fresh(docs, n) for n in ("_key", "_block", "_within", "_first"))
    counts = partition_counts(docs)
    matrix = communication_matrix(counts, shards, seed)
    blocks = max(1, -(-sum(counts.values()) // (shards * rows_per_block)))
    sent = docs.sparkSession.sparkContext.broadcast({p: a.astype(np.int64) for p, a in matrix.items()})
    schema = docs.limit(0).withColumns({"_shard": F.lit(0), key_name: F.lit(0).cast("long")}).schema

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, p])
        goes, at = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), sent.value.get(p, np.zeros(shards, np.int64)))), 0
        for batch in batches:
            n = batch.num_rows
            if at + n > len(goes):
                raise RuntimeError("the input gave other partitions when it was read again")
            key = rng.integers(0, 1 << 62, n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(goes[at : at + n]), pa.array(key)], names=[*batch.schema.names, "_shard", key_name])
            at += n
        if at != len(goes):
            raise RuntimeError("the input gave other partitions when it was read again")

    block = F.floor(F.col(key_name) / F.lit((1 << 62) / blocks)).cast("int")
    dealt = docs.mapInArrow(deal, schema).withColumn(block_name, F.least(block, F.lit(blocks - 1)))
    within = F.row_number().over(Window.partitionBy("_shard", block_name).orderBy(key_name)) - 1
    if blocks == 1:
        return dealt.withColumn("_slot", within.cast("long")).drop(key_name, block_name)
    sizes = docs.select(F.lit(1).alias("_one")).mapInArrow(deal, f"_one int, _shard int, `{key_name}` long").withColumn(block_name, F.least(block, F.lit(blocks - 1)))
    sizes = sizes.groupBy("_shard", block_name).agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.partitionBy("_shard").orderBy(block_name).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_shard", block_name, F.coalesce(first, F.lit(0)).alias(first_name))
    return dealt.withColumn(within_name, within).join(offsets, ["_shard", block_name]).withColumn("_slot", (F.col(first_name) + F.col(within_name)).cast("long")).drop(key_name, block_name, within_name, first_name)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text_or_empty("text").alias("text"))
    return shuffle_into_shards(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
