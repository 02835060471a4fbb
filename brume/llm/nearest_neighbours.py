"""Nearest neighbours by inner product: probed lists, scanned with adaptive dimensions.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the longest norm (0 for a query), so that the largest inner product is the
least distance; then all are turned by one random rotation, so that any leading columns are a random projection. Lists are the
cells of centroids fitted on a sample of `sample` vectors. Each query is compared with a share of the lists, nearest
centroids first. Within a list columns are read in blocks; after d of D columns the partial distance estimates the whole
one, and a candidate is abandoned when partial * D / d > r (1 + epsilon / sqrt(d))^2, where r is the distance of the last
neighbour that counts: at first that within the sample, then of what the scan has found. What is left is scored in double
precision on the original vectors. The nearest of the sample count as found, so every query has its k.

Equal vectors are one candidate with its k + 1 smallest ids (more can never be asked for), so a much repeated vector costs
nothing. A list is cut into blocks of rows and queries; each pair of blocks is one bounded task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

LISTS, SAMPLE, PROBED, EPSILON, COLUMNS = 64, 4096, 0.75, 2.5, 16
ROWS = 8192
PAIRS = 1 << 20


def usable(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part: as doubles, of the length that most have (of two, the longer).

    Null ids, null, empty or zero vectors and those with a null or non-finite component take no part.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (most.n if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _doubles(column: pa.ChunkedArray) -> np.ndarray:
    held = b"".join(column.to_pylist())
    return np.frombuffer(held, np.float64).reshape(len(column), -1)


class Space:
    """The rotation, the centroids and the sample that all tasks share: bounded by `lists`, `sample` and the length of a vector."""

    def __init__(self, sample: np.ndarray, longest: float, lists: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.longest = longest
        self.rotation = np.linalg.qr(rng.standard_normal((sample.shape[1] + 1,) * 2))[0]
        self.sample = self.turned(sample)
        self.centroids = self.sample[np.sort(rng.choice(len(sample), min(lists, len(sample)), replace=False))]
        for _ in range(10):
            near = self.nearest(self.sample)
            n = np.bincount(near, minlength=len(self.centroids))
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, near, self.sample)
            self.centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centroids)

    def turned(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest - (x * x).sum(1), 0))
        return np.column_stack([x, more]) @ self.rotation

    def far(self, x: np.ndarray) -> np.ndarray:
        return (self.centroids**2).sum(1) - 2 * x @ self.centroids.T

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return self.far(x).argmin(1)

    def bound(self, q: np.ndarray, k: int) -> np.ndarray:
        """Squared distance within which k vectors of the sample lie."""
        if len(self.sample) < k:
            return np.full(len(q), np.inf)
        d = (q * q).sum(1)[:, None] + (self.sample**2).sum(1) - 2 * q @ self.sample.T
        return np.partition(d, k - 1, axis=1)[:, k - 1]


def _slack(squared: np.ndarray, scale: float) -> np.ndarray:
    """A bound with room for rounding, so that ties are never lost to it."""
    return squared + 1e-9 * (np.abs(squared) + scale)


def scan(space: Space, x: np.ndarray, first: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k best candidates of a block within its bound: places of query and candidate, scores."""
    turned, asked = space.turned(x), space.turned(q, True)
    width, bound = turned.shape[1], bound.copy()
    step = max(k, 1024)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    many = max(1, PAIRS // step)
    for a in range(0, len(q), many):
        top = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for b in range(0, len(x), step):
            here = turned[b : b + step]
            some = asked[a : a + many]
            limit = _slack(bound[a : a + many], 2 * space.longest)
            one, two = some[:, :COLUMNS], here[:, :COLUMNS]
            partial = (one**2).sum(1)[:, None] + (two**2).sum(1) - 2 * one @ two.T
            d = min(COLUMNS, width)
            room = 1.0 if d == width else (1 + epsilon / sqrt(d)) ** 2
            i, j = np.nonzero(partial * (width / d) <= limit[:, None] * room)
            left = partial[i, j]
            while d < width and len(i):
                end = min(d + COLUMNS, width)
                left = left + ((some[i, d:end] - here[j, d:end]) ** 2).sum(1)
                d = end
                room = 1.0 if d == width else (1 + epsilon / sqrt(d)) ** 2
                good = left * (width / d) <= limit[i] * room
                i, j, left = i[good], j[good], left[good]
            i, j = np.concatenate([top[0], i + a]), np.concatenate([top[1], j + b])
            score = np.concatenate([top[2], (q[i[len(top[0]) :]] * x[j[len(top[0]) :]]).sum(1)])
            order = np.lexsort((first[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            last = rank == k - 1
            bound[i[last]] = np.minimum(bound[i[last]], (q[i[last]] ** 2).sum(1) + space.longest - 2 * score[last])
            top = i[rank < k], j[rank < k], score[rank < k]
        found.append(top)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else top


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, *, k: int = 20, lists: int = LISTS, probed: float = PROBED, sample: int = SAMPLE, epsilon: float = EPSILON) -> DataFrame:
    """The k nearest found of each query among `vectors`, its own id left out: (query_id, rank, vec_id, score).

    Both tables are as `usable` gives them, queries among the vectors' own rows; ids name one vector each, equal rows count
    once. Ties go to the smaller id. A query with fewer candidates gets all of them; lists are probed until they
    hold enough. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    k1 = k + 1  # one may be the query itself
    by_vector = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    classes = vectors.withColumn("n", by_vector).where(F.col("n") <= k1).groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    classes = written(classes.withColumn("first", F.col("ids")[0]), "classes")
    asking = written(queries.groupBy("v").agg(F.min("vec_id").alias("asks")), "asking")
    totals = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).first()
    if not totals.n:
        return spark.createDataFrame([], out)
    some = classes.orderBy(F.xxhash64("first"), "first").limit(sample).toArrow().combine_chunks()
    known = _matrix(some["v"].combine_chunks())
    known_first, known_ids = np.asarray(some["first"]), some["ids"].combine_chunks()
    space = Space(known, totals.longest, max(1, min(lists, totals.n // 64)))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(space.nearest(space.turned(x)), pa.int32()), *batch.columns[1:], _binary(x)], names=["list", "ids", "first", "x"])

    index = written(classes.select("v", "ids", "first").mapInArrow(put, "list int, ids array<long>, first long, x binary"), "lists")
    size = np.zeros(len(space.centroids), np.int64)
    for row in index.groupBy("list").count().collect():  # one row a list
        size[row["list"]] = row["count"]
    shares = np.maximum(1, -(-size // ROWS))
    turns = max(1, ceil(asking.count() / ROWS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                q = _matrix(part.column(0))
                turned = space.turned(q, True)
                near = np.argsort(space.far(turned), axis=1, kind="stable")
                held = np.cumsum(size[near], axis=1)
                goes = (np.arange(len(size)) < ceil(probed * len(size))) | (held - size[near] < k1)
                i, at = np.nonzero(goes & (size[near] > 0))
                places = near[i, at]
                copies = shares[places]
                i, places = np.repeat(i, copies), np.repeat(places, copies)
                share = np.concatenate([np.zeros(0, np.int64), *(np.arange(n) for n in copies.tolist())])
                bound = space.bound(turned, k1)
                asks = np.asarray(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int32()), pa.array(share, pa.int32()), pa.array(asks[i] // 20 % turns, pa.int32()), pa.array(asks[i]), pa.array(bound[i]), _binary(q).take(pa.array(i))],
                    names=["list", "share", "turn", "asks", "bound", "q"],
                )

    asked = asking.select("v", "asks").mapInArrow(ask, "list int, share int, turn int, asks long, bound double, q binary")
    cut = F.element_at(F.lit(shares.tolist()), F.col("list") + 1)
    turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn")
    there = index.select("list", F.pmod(F.xxhash64("first"), cut).cast("int").alias("share"), turn, "ids", "first", "x")
    schema = pa.schema([("asks", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                q = _matrix(part.column(0))
                i, j, score = scan(space, known, known_first, q, space.bound(space.turned(q, True), k1), k1, np.inf)
                yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(i)), pa.array(known_first[j]), known_ids.take(pa.array(j)), pa.array(score)], schema=schema)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, q, first = _doubles(left["x"]), _doubles(right["q"]), np.asarray(left["first"])
        i, j, score = scan(space, x, first, q, np.asarray(right["bound"]), k1, epsilon)
        return pa.table([right["asks"].take(pa.array(i)), pa.array(first[j]), left["ids"].take(pa.array(j)), pa.array(score)], schema=schema)

    keys = ["list", "share", "turn"]
    met = there.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "asks long, first long, ids array<long>, score double")
    met = met.unionByName(asking.select("v", "asks").mapInArrow(sampled, "asks long, first long, ids array<long>, score double")).dropDuplicates(["asks", "first"])
    best = Window.partitionBy("asks")
    met = met.withColumn("n", F.row_number().over(best.orderBy(F.desc("score"), "first"))).where(F.col("n") <= k1)
    met = met.select("asks", "score", F.explode("ids").alias("vec_id")).withColumn("n", F.row_number().over(best.orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k1)
    lists_of = met.groupBy("asks").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    lists_of = written(asking.join(lists_of, "asks").select("v", "near"), "near")
    own = queries.select("v", F.col("vec_id").alias("query_id")).distinct().join(lists_of, "v")
    own = own.select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return nearest_neighbours(rows, rows.where("vec_id % 20 = 0"))
