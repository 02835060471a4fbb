"""The registered queries: columns, types and values of their contracts against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from brume.llm import sharding, suffix_dedup
from brume.llm.common import BYTE_MODEL, WORD_MODEL, load_tokenizer, tokenizer_path

from .test_repeats import brute_quality
from .texts import corpus, table

TYPES = {
    "op1_packing": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
    "op2_html_extraction": "page_id:bigint url:string text:string n_chars:bigint",
    "op4_token_counts": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean",
    "op6_quality_rules": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op7_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op8_token_store": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op9_suffix_array_dedup": "doc_id:bigint n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    "op10_lm_scoring": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
}
TEXTS = {i: t for i, t in corpus()[:-4]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    table(spark, list(TEXTS.items())).write.parquet(f"{path}/documents.parquet")
    page = "<html><body><nav><a href=/>Home</a></nav><article><h1>Title {0}</h1><p>Text&nbsp;of {0} &amp; more.</p></article><footer>All rights</footer></body></html>"
    rows = [(i, f"http://h{i % 3}.example/{i}", page.format(f"page{i}") if i else None) for i in range(12)]
    spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").write.parquet(f"{path}/pages.parquet")
    return path


def result(spark, folder, name):
    return __spark_entry__.queries()[name](spark, folder)


@pytest.mark.parametrize("name", list(TYPES))
def test_columns_and_types(spark, folder, name):
    found = dict(result(spark, folder, name).dtypes)
    wanted = dict(x.split(":") for x in TYPES[name].split())
    assert {k: found[k] for k in wanted} == wanted


def ids_of(text):
    return [*load_tokenizer(tokenizer_path(WORD_MODEL)).encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, folder):
    rows = result(spark, folder, "op1_packing").collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == TEXTS.keys()
    for i, own in pieces.items():
        ids, at = ids_of(TEXTS[i]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_op2(spark, folder):
    for r in result(spark, folder, "op2_html_extraction").collect():
        want = f"Title page{r.page_id}\nText of page{r.page_id} & more." if r.page_id else ""
        assert (r.text, r.n_chars, r.url) == (want, len(want), f"http://h{r.page_id % 3}.example/{r.page_id}")


def test_op4(spark, folder):
    library = load_tokenizer(tokenizer_path(BYTE_MODEL))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in result(spark, folder, "op4_token_counts").collect()}
    count = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS.items()}
    assert got == {i: (len((t or "").encode()), count[i], count[i] > 1024) for i, t in TEXTS.items()}


def test_op6(spark, folder):
    got = {r.doc_id: r for r in result(spark, folder, "op6_quality_rules").collect()}
    assert got.keys() == TEXTS.keys()
    for i, t in TEXTS.items():
        n, *rest = brute_quality(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 50 or 100 * rest[-1] > 50 * n) and not (r.kept and r.base_failed)


def test_op7(spark, folder):
    rows = result(spark, folder, "op7_sharding").collect()
    bodies = {i: (t or "").encode() for i, t in TEXTS.items()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(b) + 8, zlib.crc32(b)) for i, b in bodies.items()}
    assert len(rows) == len(TEXTS) and all(r.law == "rows" and r.grown_shard is None for r in rows)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(24)) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())


def test_rows_are_dealt_beyond_a_thousand_million():
    counts = {0: 6 * 10**8, 1: 6 * 10**8, 2: 4 * 10**12}
    matrix = sharding.communication_matrix(counts, 24, 3)
    assert {p: int(m.sum()) for p, m in matrix.items()} == counts and all((m >= 0).all() for m in matrix.values())
    total = sum(matrix.values())
    assert total.max() - total.min() <= 1
    rng = np.random.default_rng(4)
    for good, bad, n in ((50, 70, 40), (1000, 30, 200), (60, 60, 13), (10**6, 2 * 10**6, 5 * 10**4)):
        mine = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(4000)])
        other = rng.hypergeometric(good, bad, n, 4000)
        assert abs(mine.mean() - other.mean()) < 6 * other.std() / 4000**0.5 and 0.93 < mine.std() / other.std() < 1.07


def test_op8(spark, folder):
    start = 0
    got = {r.doc_id: r for r in result(spark, folder, "op8_token_store").collect()}
    assert got.keys() == TEXTS.keys()
    for i in sorted(TEXTS):
        ids = ids_of(TEXTS[i])
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def cut_everywhere(rows, least):
    """What is left of each text without the bytes of strings that also start elsewhere; strings by their SHA-1."""
    count: Counter = Counter()
    strings = []
    for b in rows:
        own = [hashlib.sha1(b[i : i + least]).digest() for i in range(len(b) - least + 1)]
        count.update(own)
        strings.append(own)
    out = []
    for b, own in zip(rows, strings, strict=True):
        edge = np.zeros(len(b) + 1, int)
        for i, s in enumerate(own):
            if count[s] > 1:
                edge[i] += 1
                edge[i + least] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum())))
    return out


def test_op9(spark, folder):
    want = dict(zip(TEXTS, cut_everywhere([(t or "").encode() for t in TEXTS.values()], 400), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result(spark, folder, "op9_suffix_array_dedup").collect()}
    assert got == {i: (len((TEXTS[i] or "").encode()), removed, spans, hashlib.sha256(kept).hexdigest()) for i, (kept, removed, spans) in want.items()}


def test_repeats_in_texts_of_more_than_a_segment(spark):
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    passage, edge = words(80), suffix_dedup.SEGMENT
    long = words(edge // 7 + 40_000)
    texts = [long[: edge - 200] + passage + long[edge - 200 :], words(50) + passage + words(50), long[edge - 3000 : edge + 3000]]
    got = suffix_dedup.dedup(table(spark, list(enumerate(texts)), 2), keep_first=False).collect()
    want = cut_everywhere([t.encode() for t in texts], 400)
    assert {r.doc_id: (bytes(r["_kept"]), r["_removed"], r["_spans"]) for r in got} == dict(enumerate(want))


def test_a_crowded_passage(spark):
    """One passage in 300 texts that differ around it, and a common part of different lengths beside it."""
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    passage = words(90)
    texts = [words(rng.randint(0, 30)) + " " + passage + " " + words(20 if k % 3 else 0) + passage[: 7 * k] for k in range(300)]
    want = cut_everywhere([t.encode() for t in texts], 200)
    for hot in (512, 20, 2):
        got = suffix_dedup.dedup(table(spark, list(enumerate(texts)), 4), least=200, keep_first=False, hot=hot).collect()
        assert {r.doc_id: (bytes(r["_kept"]), r["_removed"], r["_spans"]) for r in got} == dict(enumerate(want))


def test_every_query_is_registered():
    assert {f"op{n}_" for n in range(1, 11)} == {k.split("_")[0] + "_" for k in __spark_entry__.queries() if k.startswith("op")}
    assert "pipeline" in __spark_entry__.queries()


def test_documents_scored_once(spark, folder):
    got = result(spark, folder, "op10_lm_scoring")
    assert got.count() == len(TEXTS) and got.where(F.col("score") > 0).count() == 0
