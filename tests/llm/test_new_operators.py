"""Neighbours, fill-in-middle and the conversation trie against brute force, with the hard rows of each."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from brume.llm import conversation_trie as trie
from brume.llm import fill_in_middle as fim
from brume.llm import nearest_neighbours as near
from brume.llm import sharding

from .texts import corpus, empty, table


# fill-in-middle


def brute_middle(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    if h4 % 100 < 50:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles_equal_brute_force(spark):
    rng = random.Random(3)
    extra = [(1000 + i, "".join(rng.choice(["a", "é", "\n", "\n\n", "<", "P>", "<S", ">", "\r"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    extra += [(2000, "x\n" * 30_000), (2001, "long line " * 90_000 + "\nend"), (2002, "<M>"), (None, "null id\nline")]
    rows = corpus() + extra
    found = fim.fill_in_middle(table(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((i, *brute_middle(i, t))) for i, t in rows)
    back = fim.restored(fim.fill_in_middle(table(spark, extra))).collect()
    assert sorted(r.restored for r in back) == sorted(t for _, t in extra)
    assert fim.fill_in_middle(empty(spark)).count() == 0


@pytest.mark.parametrize("error", [0, 1, 8, 512])
def test_pieces_are_within_their_error_and_exact_with_residuals(error):
    rng = np.random.default_rng(error)
    texts = [b"", b"x", b"\n" * 500, b"".join(b"a" * int(n) + b"\n" for n in rng.integers(0, 3000, 700)), b"tail\nopen"]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    first, offsets = fim.boundaries(np.frombuffer(b"".join(texts), np.uint8), at)
    index = fim.fit(first, offsets, error)
    assert np.abs(index.residual).max() <= error + 1
    for i, text in enumerate(texts):
        ends = np.cumsum([0, *(len(x) for x in re.findall(rb"[^\n]*\n|[^\n]+", text))])
        assert index.lookup(np.full(len(ends), i), np.arange(len(ends))).tolist() == ends.tolist()


# neighbours


def brute_near(rows, k):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            score = (x * np.array(v)).sum(1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def searched(spark, rows, schema="vec_id LONG, embedding ARRAY<FLOAT>, n INT, v STRING, list INT", **options):
    df = near.usable(spark.createDataFrame([(*r, 1, "v", 2) for r in rows], schema).repartition(3))
    out = defaultdict(list)
    for r in near.nearest_neighbours(df, df.where("vec_id % 20 = 0"), **options).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def test_neighbours_with_copies_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-8, 9, 12).astype(float).tolist()) for i in range(300)]
    rows += [(i, [1.0] * 12) for i in range(300, 420)] + [(7, rows[7][1])]
    bad = [(900, None), (920, [0.0] * 12), (940, [float("nan")] + [1.0] * 11), (960, [float("inf")] + [1.0] * 11), (980, [None] + [1.0] * 11), (1000, [1.0] * 5), (None, [9.0] * 12), (1020, [])]
    good = [(i, v) for i, v in rows if any(v)]
    assert searched(spark, rows + bad, probed=1.0, epsilon=np.inf) == brute_near(good, 20)


def test_neighbours_of_few_or_no_rows(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(5)]
    assert searched(spark, rows) == brute_near(rows, 20)
    assert searched(spark, [(0, [1.0, 2.0])]) == {}
    assert searched(spark, [(0, None)]) == {}


def test_recall_of_probed_lists_and_abandoned_candidates(spark, monkeypatch):
    monkeypatch.setattr(near, "ROWS", 256)  # lists in several blocks, queries in several turns
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6000, 48))
    x *= rng.uniform(0.5, 2, (6000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]
    found, right = searched(spark, rows, sample=1000), brute_near(rows, 20)
    assert set(found) == set(right) and all(len(v) == 20 for v in found.values())
    exact = dict((q, dict(v)) for q, v in brute_near(rows, 6000).items())
    assert all(exact[q][i] == s for q, v in found.items() for i, s in v)
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in right[q]}) / 20 for q in right]) >= 0.9


# conversation trie


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[q] for q in kids[p])
    digest = lambda p: hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(kids[p]), leaves[p], saved[p], digest(p)) for p in members)


def nodes(spark, rows, tmp_path):
    schema = "conv_id LONG, turn LONG, role STRING, text STRING, id STRING, part STRING, depth INT"
    spark.createDataFrame([(*r, "x", "y", 3) for r in rows], schema).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = trie.op13_conversation_trie(spark, str(tmp_path)).fillna(-1, ["parent_conv_id"]).collect()
    return sorted(map(tuple, found))


def test_trie_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "a b  c", "", None, "é 　 x"])) for c in range(80) for t in range(rng.randint(0, 5)) if c % 20 or c != 40]
    rows += [(100, t, "user", f"turn {t} of a long one") for t in range(150)] + [(105, t, "user", f"turn {t} of a long one") for t in range(140)]
    rows += [(c, 0, "user", "hot") for c in range(200, 240)] + [(220, 0, "user", "hot"), (221, None, "b", "x"), (221, None, "a", "y"), (None, 1, "user", "lost")]
    assert nodes(spark, rows, tmp_path) == brute_trie(rows)


def test_trie_of_nothing(spark, tmp_path):
    assert nodes(spark, [], tmp_path) == []


# shards


def test_a_partition_that_shrinks_is_an_error(spark, monkeypatch):
    docs = table(spark, [(i, str(i)) for i in range(60)])
    counts = sharding.partition_counts(docs)
    monkeypatch.setattr(sharding, "partition_counts", lambda _: {p: n + 2 for p, n in counts.items()})
    with pytest.raises(Exception, match="other partitions"):
        sharding.shuffle_into_shards(docs).count()
