"""Token ids in a content-addressed store.

Files (Parquet tables under one folder):

* `objects`: `kind = 'chunk'` rows hold `digest` (BLAKE2b, 16 bytes) and `payload` (ids, unsigned little-endian,
  2 bytes where the vocabulary allows, else 4). Equal chunks are stored once. `kind = 'recipe'` rows hold a document's
  chunks as they leave the encoder.
* `recipes`: in ascending doc_id order, one file (block) per range of ids: block, `place` (in the block), `local_start`
  (ids before the document in its block), `n_tokens`, the document's root and its chunks (digest, `end` = ids up to and
  with this chunk).
* `manifest`: block, start (ids before the block), n_docs, n_tokens, root, and the store's root over all blocks.

Chunks end where a rolling hash over the last 16 ids has its low bits zero, so equal passages give equal chunks
wherever they stand. Roots form a Merkle tree: chunks, document, page (PAGE documents), block, store. Reading back
checks every payload against its digest, every document's root and length, and the roots of pages, blocks and store
against the manifest; it fails on any difference, so on a row or a file that is gone as well.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_MODEL, byte_groups, load_tokenizer, shared_dir, shuffles_end, text_bytes, text_or_empty, tokenizer_path, unit_encoder

WINDOW, LEAST, MEAN, MOST = 16, 128, 512, 4096
PAGE = 1024
OBJECTS = "kind string, digest binary, payload binary, doc_id long, n_tokens long, chunks array<struct<digest: binary, end: long>>"
RECIPES = "block int, place long, doc_id long, local_start long, n_tokens long, root binary, chunks array<struct<digest: binary, end: long>>"


def digest_of(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def cut_places(ids: np.ndarray) -> np.ndarray:
    """Places after which a rolling hash would end a chunk; only WINDOW ids before a place decide."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    for step in (1, 2, 4, 8):  # sum of the last 16 values, each shifted by its distance
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint64(step)
        h = h + shifted
    h ^= h >> np.uint64(32)
    return np.flatnonzero((h * np.uint64(0x94D049BB133111EB)) >> np.uint64(40) & np.uint64(MEAN - 1) == 0) + 1


def chunk_ends(n: int, places: list[int]) -> list[int]:
    """Ends of the chunks of n ids: at hash places, LEAST to MOST ids apart."""
    ends, last = [], 0
    for place in [*places, n]:
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST or place == n and place > last:
            last = place
            ends.append(last)
    return ends


def _encode(path: str, end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width, seen = unit_encoder(path, words=True), int(dtype[-1]), set()
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for a, b in byte_groups(np.diff(at), 4 << 20):
                ids, offsets = encoder.encode(data[at[a] : at[b]], at[a : b + 1] - at[a], end_id)
                places, payload = cut_places(ids), ids.astype(dtype).tobytes()
                first = np.searchsorted(places, offsets + WINDOW)
                digests, ends, counts, roots, new = [], [], [], [], {}
                for k, (s, e) in enumerate(pairwise(offsets.tolist())):
                    cuts = chunk_ends(e - s, (places[first[k] : np.searchsorted(places, e)] - s).tolist())
                    own, last = [], 0
                    for cut in cuts:
                        body = payload[(s + last) * width : (s + cut) * width]
                        own.append(digest := digest_of(body))
                        if digest not in seen:
                            seen.add(digest)
                            new[digest] = body
                        last = cut
                    digests += own
                    ends += cuts
                    counts.append(len(cuts))
                    roots.append(digest_of(b"".join(own)))
                n = b - a
                chunks = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(ends, pa.int64())], names=["digest", "end"]))
                names = ["kind", "digest", "payload", "doc_id", "n_tokens", "chunks"]
                yield pa.RecordBatch.from_arrays([pa.array(["recipe"] * n), pa.array(roots, pa.binary()), pa.nulls(n, pa.binary()), batch.column(0).slice(a, n), pa.array(np.diff(offsets), pa.int64()), chunks], names=names)
                m = len(new)
                yield pa.RecordBatch.from_arrays([pa.array(["chunk"] * m), pa.array(list(new), pa.binary()), pa.array(list(new.values()), pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, chunks.type)], names=names)

    return run


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by kind and digest, without the chunks that repeat the one before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        digest, chunk = batch.column(1), pc.equal(batch.column(0), "chunk")
        before = pa.concat_arrays([pa.array([last], pa.binary()), digest.slice(0, batch.num_rows - 1)])
        last = digest[-1].as_py() if chunk[-1].as_py() else None
        yield batch.filter(pc.invert(pc.and_(chunk, pc.fill_null(pc.equal(digest, before), False))))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the documents and ids of one sorted range of documents."""
    block, start, place = TaskContext.get().partitionId(), 0, 0
    names = ["block", "place", "doc_id", "local_start", "n_tokens", "root", "chunks"]
    for batch in batches:
        n = batch.num_rows
        if n:
            tokens = batch.column(2).to_numpy(zero_copy_only=False)
            ends = np.cumsum(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int32)), pa.array(place + np.arange(n)), batch.column(0), pa.array(start + ends - tokens, pa.int64()), batch.column(2), batch.column(1), batch.column(3)], names=names)
            start, place = start + int(ends[-1]), place + n


def _root(key: str, root: Column) -> Column:
    """SHA-256 over the roots of a group in the order of `key`."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), root.alias("r"))))
    return F.sha2(F.array_join(F.transform(ordered, lambda x: x["r"]), ""), 256)


def block_roots(recipes: DataFrame) -> DataFrame:
    """block, n_docs, n_tokens and root of each block, from the roots of its documents; no group holds more than a page's or a block's."""
    pages = recipes.groupBy("block", F.floor(F.col("place") / PAGE).alias("page")).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), _root("place", F.hex("root")).alias("root"))
    return pages.groupBy("block").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), _root("page", F.col("root")).alias("root"))


def store_root(roots: list[str]) -> str:
    return hashlib.sha256("".join(roots).encode()).hexdigest()


def write_store(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every text, with `end_id` after it, into the store at `path`.

    A null or empty text is the end id alone; null ids come first; rows that repeat an id follow each other, ordered
    by root; other columns are ignored; an empty table gives an empty store.
    """
    spark = docs.sparkSession
    vocabulary = tokenizer or tokenizer_path(WORD_MODEL)
    dtype = "<u2" if load_tokenizer(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"
    encoded = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(_encode(vocabulary, end_id, dtype), OBJECTS)
    spread = F.when(F.col("kind") == "recipe", F.xxhash64("doc_id"))  # copies of a text have one root, but each its own recipe
    once = encoded.repartition("digest", spread).sortWithinPartitions("kind", "digest").mapInArrow(_first_of_each, OBJECTS).withColumn("dtype", F.lit(dtype))
    with shuffles_end(spark):
        once.write.option("compression", "zstd").parquet(f"{path}/objects")
    recipes = _objects(spark, path).where("kind = 'recipe'").select("doc_id", F.col("digest").alias("root"), "n_tokens", "chunks")
    with shuffles_end(spark):
        recipes.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "root").mapInArrow(_blocks, RECIPES).write.option("compression", "zstd").parquet(f"{path}/recipes")
    ends = block_roots(spark.read.schema(RECIPES).parquet(f"{path}/recipes")).orderBy("block").collect()  # one row per file
    store, start, rows = store_root([r["root"] for r in ends]), 0, []
    for r in ends:
        rows.append((r["block"], start, r["n_docs"], r["n_tokens"], r["root"], store))
        start += r["n_tokens"]
    spark.createDataFrame(rows, "block int, start long, n_docs long, n_tokens long, root string, store_root string").coalesce(1).write.parquet(f"{path}/manifest")


def _objects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{OBJECTS}, dtype string").parquet(f"{path}/objects")


def verify(spark: SparkSession, path: str) -> None:
    """Compare the roots of the recipes as they are with the manifest, and the manifest with the store's root."""
    manifest = spark.read.parquet(f"{path}/manifest").orderBy("block").collect()  # one row per file
    if any(r["store_root"] != store_root([x["root"] for x in manifest]) for r in manifest):
        raise ValueError("the manifest differs from its root")
    found = {r["block"]: (r["n_docs"], r["n_tokens"], r["root"]) for r in block_roots(spark.read.schema(RECIPES).parquet(f"{path}/recipes")).collect()}
    if found != {r["block"]: (r["n_docs"], r["n_tokens"], r["root"]) for r in manifest}:
        raise ValueError("the recipes differ from the manifest")


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document: start, doc_id, n_tokens, root, chunks."""
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes")
    manifest = spark.read.parquet(f"{path}/manifest").select("block", "start")
    return recipes.join(manifest, "block").select((F.col("start") + F.col("local_start")).alias("start"), "doc_id", "n_tokens", "root", "chunks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """start, doc_id, n_tokens and all ids of each document (array<int>), rebuilt from the chunks, after `verify`."""
    verify(spark, path)
    chunks = _objects(spark, path).where("kind = 'chunk'").select("digest", "payload", "dtype").mapInArrow(_decoded, "digest binary, ids array<int>")
    parts = _recipes(spark, path).mapInArrow(_rooted, "start long, doc_id long, n_tokens long, digest binary, after long").join(chunks, "digest")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("after")).alias("k"), "ids")))
    return parts.groupBy("start", "doc_id", "n_tokens").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))


@functools.lru_cache(maxsize=1)
def _crc_tables() -> list[np.ndarray]:
    """For each j, tables (4 x 256) that move a CRC-32 past 2**j bytes."""
    columns = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint32)  # past one bit

    def times(m: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.zeros_like(v)
        for i in range(32):
            out ^= np.where(v >> np.uint32(i) & np.uint32(1), m[i], np.uint32(0)).astype(np.uint32)
        return out

    for _ in range(3):
        columns = times(columns, columns)
    tables = []
    for _ in range(44):
        byte = np.arange(256, dtype=np.uint32)
        tables.append(np.stack([times(columns, byte << np.uint32(8 * k)) for k in range(4)]))
        columns = times(columns, columns)
    return tables


def crc_shift(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 values as if n_bytes more bytes followed, so that crc(a + b) = crc_shift(crc(a), len(b)) ^ crc(b)."""
    out, left = crc.astype(np.uint32), n_bytes.astype(np.int64)
    for j, t in enumerate(_crc_tables()):
        if not (left >> j).any():
            break
        on = np.flatnonzero(left >> j & 1)
        v = out[on]
        out[on] = t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
    return out


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Digests of chunks and their ids as 32-bit integers, after a check of each digest."""
    for batch in batches:
        digests, payloads, dtypes = (c.to_pylist() for c in batch.columns)
        if any(digest_of(payload) != digest for digest, payload in zip(digests, payloads, strict=True)):
            raise ValueError("a chunk differs from its digest")
        yield batch.column(0), [np.frombuffer(p, d).astype("<u4") for p, d in zip(payloads, dtypes, strict=True)]


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for digests, ids in _payloads(batches):
        yield pa.RecordBatch.from_arrays([digests, pa.array([x.view(np.int32) for x in ids], pa.list_(pa.int32()))], names=["digest", "ids"])


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CRC-32 of each chunk's ids."""
    for digests, ids in _payloads(batches):
        yield pa.RecordBatch.from_arrays([digests, pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([len(x) for x in ids], pa.int64())], names=["digest", "crc", "n"])


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of each document, after a check of the document's root."""
    for batch in batches:
        roots, chunks = batch.column(3).to_pylist(), batch.column(4)
        flat, count = chunks.flatten(), np.asarray(chunks.value_lengths())
        digests, at = flat.field(0).to_pylist(), 0
        for root, k in zip(roots, count.tolist(), strict=True):
            if digest_of(b"".join(digests[at : at + k])) != root:
                raise ValueError("a recipe differs from its root")
            at += k
        row = pa.array(np.repeat(np.arange(batch.num_rows), count))
        tokens = batch.column(2).take(row)
        after = tokens.to_numpy() - flat.field(1).to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), tokens, flat.field(0), pa.array(4 * after, pa.int64())], names=["start", "doc_id", "n_tokens", "digest", "after"])


def read_checks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files.

    A document's CRC is put together from those of its chunks, so no payload is moved; every digest, root and length
    is checked on the way, after `verify`.
    """
    verify(spark, path)

    @F.pandas_udf("long")
    def shifted(crc: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series(crc_shift(crc.to_numpy(), after.to_numpy()).astype(np.int64))

    chunks = _objects(spark, path).where("kind = 'chunk'").select("digest", "payload", "dtype").mapInArrow(_checked, "digest binary, crc long, n long")
    parts = _recipes(spark, path).mapInArrow(_rooted, "start long, doc_id long, n_tokens long, digest binary, after long").join(chunks, "digest")
    whole = parts.withColumn("part", shifted("crc", "after")).groupBy("start", "doc_id", "n_tokens").agg(F.bit_xor("part").alias("ids_crc32"), F.sum("n").alias("n"))
    right = F.when(F.col("n") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a document has lost chunks")).cast("long"))
    return whole.select("doc_id", "start", right.alias("n_tokens"), "ids_crc32")


def op8_token_store(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}-tokens"
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_checks(spark, path)
