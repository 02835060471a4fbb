"""Packing, token counts and the token store against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brume.llm import packing, token_counts, token_store
from brume.llm.common import BYTE_MODEL, WORD_MODEL, load_tokenizer, shared_dir, text_bytes, tokenizer_path, unit_encoder

from .texts import corpus, empty, table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus())


def ids_of(text):
    return load_tokenizer(tokenizer_path(WORD_MODEL)).encode(text or "", add_special_tokens=False).ids + [1]


PIECES = [*"aAbé.,;:!?'|<>s 0\t\n İŉ#零", "<|endoftext|>", "'s", "The "]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=60).map("".join), max_size=4))
def test_units_encode_as_whole_texts(texts):
    data, at = text_bytes(pa.array(texts, pa.string()))
    words, library = unit_encoder(tokenizer_path(WORD_MODEL), True), load_tokenizer(tokenizer_path(WORD_MODEL))
    ids, offsets = words.encode(data, at, 1)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    plain = [t.replace(" ", "") for t in texts]
    data, at = text_bytes(pa.array(plain, pa.string()))
    byte = unit_encoder(tokenizer_path(BYTE_MODEL), False)
    assert np.diff(byte.encode(data, at)[1]).tolist() == [len(load_tokenizer(tokenizer_path(BYTE_MODEL)).encode(t, add_special_tokens=False).ids) for t in plain]


def test_packing_places_every_id_once(docs):
    pieces = packing.pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    want = defaultdict(list)
    for i, text in corpus():
        want[i].append(tuple(ids_of(text)))
    for i, texts in want.items():
        got = Counter()
        for p in by_doc[i]:
            got.update((p.doc_tokens, p.start + k, x) for k, x in enumerate(np.frombuffer(p.ids, "<u4").tolist()))
        assert got == Counter((len(t), k, x) for t in texts for k, x in enumerate(t))
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts[:-1]]).tolist()
        size = sum(p.length for p in parts)
        assert size <= 2048
        padding += 0 if size & (size - 1) == 0 else 2048 - size
    assert padding <= 0.02 * sum(p.length for p in pieces)


@given(st.lists(st.integers(1, 512), min_size=1, max_size=120))
@settings(max_examples=60, deadline=None)
def test_differencing_deals_each_item_once(sizes):
    windows = packing.near_equal(np.array(sizes), 512)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 512 for w in windows)
    assert len(windows) >= -(-sum(sizes) // 512)


def test_token_counts_match_the_library(docs):
    library = load_tokenizer(tokenizer_path(BYTE_MODEL))
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in corpus())
    for options in ({}, {"chunk": 200, "overlap": 40}, {"chunk": 64, "overlap": 3}):
        got = token_counts.token_counts(docs, **options).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


@given(st.lists(st.sampled_from([*"ab é.'  \n", "<|endoftext|>", "零"]), max_size=400).map("".join), st.integers(3, 40), st.integers(1, 12))
@settings(max_examples=150, deadline=None)
def test_chunks_splice_to_the_whole(text, chunk, overlap):
    library = load_tokenizer(tokenizer_path(BYTE_MODEL))
    assert token_counts.count_huge(library, text, chunk, overlap) == len(library.encode(text, add_special_tokens=False).ids)


@given(st.lists(st.sampled_from([*"ab é.'  \n", "word ", "<|endoftext|>", "零", " and then"]), max_size=400).map("".join), st.integers(30, 90), st.integers(1, 29))
@settings(max_examples=150, deadline=None)
def test_chunks_of_units_splice_to_the_whole(text, chunk, overlap):
    """Either the exact count, or none where the overlap has no common boundary."""
    path = tokenizer_path(BYTE_MODEL)
    texts = pa.array([text, "", text * 2])
    got = token_counts._counted(unit_encoder(path, False), *text_bytes(texts), chunk, overlap).tolist()
    want = [len(load_tokenizer(path).encode(t, add_special_tokens=False).ids) for t in texts.to_pylist()]
    assert all(g in (-1, w) for g, w in zip(got, want, strict=True))
    assert overlap < 25 or " " * 2 in text or len(text) > 60 or got[0] == want[0]


def test_usual_texts_are_spliced():
    """Prose needs no wider overlap: no text falls back to the library."""
    path = tokenizer_path(BYTE_MODEL)
    texts = pa.array([" ".join(random.Random(i).choices(["one", "other", "naïve", "words,", "x."], k=40 * i)) for i in range(60)])
    got = token_counts._counted(unit_encoder(path, False), *text_bytes(texts), 512, 64).tolist()
    assert got == [len(load_tokenizer(path).encode(t, add_special_tokens=False).ids) for t in texts.to_pylist()]


def test_store_gives_every_id_back(spark, docs):
    path = shared_dir(spark)
    token_store.write_store(docs, path)
    checks = sorted(token_store.read_checks(spark, path).collect(), key=lambda r: r.start)
    whole = {r.start: r for r in token_store.read_ids(spark, path).collect()}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in checks) == Counter((i, len(ids_of(t)), crc(ids_of(t))) for i, t in corpus())
    start = 0
    for r in checks:
        assert r.start == start and crc(whole[start].ids) == r.ids_crc32
        start += r.n_tokens
    known = [r.doc_id for r in checks if r.doc_id is not None]
    assert known == sorted(known)
    objects = spark.read.parquet(f"{path}/objects").where("kind = 'chunk'")
    assert objects.count() == objects.select("digest").distinct().count()


def test_store_notices_rows_that_are_gone(spark, docs):
    path = f"{shared_dir(spark)}-tokens"
    token_store.write_store(docs, path)
    recipes = spark.read.parquet(f"{path}/recipes")
    for name, left in (("one", recipes.where("doc_id is null or doc_id <> 15")), ("block", recipes.where("block <> 0")), ("length", recipes.withColumn("n_tokens", F.col("n_tokens") + 1))):
        left.write.parquet(f"{path}-{name}/recipes")
        for table in ("objects", "manifest"):
            spark.read.parquet(f"{path}/{table}").write.parquet(f"{path}-{name}/{table}")
        with pytest.raises(ValueError, match="differ from the manifest"):
            token_store.read_checks(spark, f"{path}-{name}")
        with pytest.raises(ValueError, match="differ from the manifest"):
            token_store.read_ids(spark, f"{path}-{name}")
    other = spark.read.parquet(f"{path}/manifest").withColumn("root", F.sha2("root", 256))
    other.write.parquet(f"{path}-short/manifest")
    with pytest.raises(ValueError, match="differs from its root"):
        token_store.verify(spark, f"{path}-short")


def test_store_notices_a_changed_chunk(spark, docs):
    path = shared_dir(spark)
    token_store.write_store(docs, path)
    objects = spark.read.parquet(f"{path}/objects").selectExpr("kind", "digest", "CASE WHEN kind = 'chunk' THEN concat(payload, X'0000') END AS payload", "doc_id", "n_tokens", "chunks", "dtype").checkpoint()
    objects.write.mode("overwrite").parquet(f"{path}/objects")
    with pytest.raises(Exception, match="differs from its digest"):
        token_store.read_checks(spark, path).collect()


def test_crc_shift_joins_checksums():
    a, b = b"some bytes", b"and some more of them" * 50
    assert int(token_store.crc_shift(np.array([zlib.crc32(a)]), np.array([len(b)]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_empty_tables(spark):
    none = empty(spark)
    assert packing.pack(none).count() == 0
    assert token_counts.token_counts(none).count() == 0
    path = shared_dir(spark)
    token_store.write_store(none, path)
    assert token_store.read_checks(spark, path).count() == 0
