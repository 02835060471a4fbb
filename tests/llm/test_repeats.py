"""Near duplicates, repeated strings, leaks and quality against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brume.llm import decontamination, hashing, jaccard_join, quality_rules, suffix_dedup

from .texts import corpus, empty, table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus())


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = defaultdict(set)
    for i in range(len(rows)):
        for j in range(len(rows)):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            shared = len(sets[i] & sets[j])
            close = shared and shared >= threshold * (len(sets[i]) + len(sets[j]) - shared)
            if i != j and (same or close):
                root[find(i)] = find(j)
                if not same:
                    links[i].add(rows[j][1])
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    first = {g: min((k is None, k) for k in members)[1] if any(k is not None for k in members) else None for g, members in groups.items()}
    return Counter((rows[i][0], first[find(i)], len(links[i])) for i in range(len(rows)))


def test_near_duplicates_match_brute_force(docs):
    got = jaccard_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(corpus())
    texts = Counter(t or "" for _, t in corpus())
    assert Counter(r.n_copies for r in got) == Counter(texts[t or ""] for _, t in corpus())
    kept = jaccard_join.keep_firsts(docs)
    assert kept.columns == docs.columns and kept.count() == len({(r.class_id, r.is_first) for r in got if r.is_first}) + sum(r.class_id is None for r in got if r.is_first) - (1 if any(r.class_id is None for r in got) else 0)


def test_near_duplicates_of_a_crowd(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(300):
        words = list(base)
        words[(7 * k) % 120] = f"changed{k}"
        rows.append((k, " ".join(words)))
    got = jaccard_join.near_duplicates(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(rows)


def test_large_clusters_are_split(spark, docs, monkeypatch):
    """Of 150 texts that are no copies, no group that meets in one task holds more than two blocks."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for n in range(1 + k % 14):
            words[(7 * k + 5 * n) % 120] = f"changed{k}"
        rows.append((k, " ".join(words)))
    got = jaccard_join.near_duplicates(table(spark, rows), block_texts=20, block_leaders=4).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(rows)
    dealt = jaccard_join._met(spark.range(1000).withColumnRenamed("id", "row"), F.lit(10), True)
    assert max(r["count"] for r in dealt.groupBy("one", "two").count().collect()) < 300
    got = jaccard_join.near_duplicates(docs, block_texts=1, block_leaders=1).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(corpus())
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 5000)
    got = jaccard_join.near_duplicates(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(rows)


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (9, 8), (20, 2), (30, 9), (7, 7)]
    got = jaccard_join.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()
    assert {(r.node, r.root) for r in got} == {(n, 2) for n in (2, 3, 4, 5, 20)} | {(n, 8) for n in (8, 9, 30)}


def test_measured_recall_of_links(spark):
    """Of 600 lonely pairs of similarity 0.8 to 0.9, dealt over partitions, 99.5 in 100 are linked, and none of 0.79 or less is."""
    rows, near = [], []
    for k in range(800):
        changed = 3 + k % 6  # single words changed far apart, each in five of 296 shingles
        base = [f"p{k}w{i}" for i in range(300)]
        other = [f"new{i}" if i % 25 == 10 and i // 25 < changed else w for i, w in enumerate(base)]
        shared = len(shingles(" ".join(base)) & shingles(" ".join(other)))
        near.append(shared >= 0.8 * (2 * 296 - shared))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(table(spark, rows, 5)).collect()}
    linked = [got[2 * k + 1].class_id == 2 * k and got[2 * k].n_links == 1 for k in range(800)]
    assert not any(found for found, right in zip(linked, near, strict=True) if not right)
    assert sum(near) > 300 and sum(linked) >= 0.995 * sum(near)


def test_prefixes_are_shortened_as_far_as_needed():
    """Dense texts meet at whole labels and stop there; a lonely pair meets at the shortest prefix only."""
    rng = np.random.default_rng(3)
    low = np.tile(rng.integers(0, 256, 72, dtype=np.uint8), (12, 1))
    options = {"enough": 0.25, "threshold": 0.8, "missed": 0.001 ** (1 / 12), "shortest": 3, "stars": False}
    labels = low[:, :6].copy()
    assert len(jaccard_join.forest_links(labels, low, **options)) == 11
    labels[6:, 5] += 1  # two dense nodes of one parent: with five copies each at hand, nothing is shortened
    assert len(jaccard_join.forest_links(labels, low, **options)) == 10
    for length in (5, 4, 3):
        pair = low[:2, :6].copy()
        pair[1, length] += 1
        assert jaccard_join.forest_links(pair, low[:2], **options) == [(0, 1)]
    pair = low[:2, :6].copy()
    pair[1, 2] += 1
    assert jaccard_join.forest_links(pair, low[:2], **options) == []


def test_near_duplicates_without_broadcasts(docs):
    got = jaccard_join.near_duplicates(docs, max_broadcast=0).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(corpus())
    assert jaccard_join.keep_firsts(docs, max_broadcast=0).count() == sum(r.is_first for r in got)
    again = jaccard_join.near_duplicates(docs.where("doc_id is null or doc_id >= 0").distinct()).collect()  # not a scan
    assert {(r.doc_id, r.class_id, r.n_links) for r in again} == {(r.doc_id, r.class_id, r.n_links) for r in got}


def test_prefix_reaches_the_recall():
    m = jaccard_join.prefix_length(0.8, 12, 6, 0.999)
    assert 1 - (1 - 0.8**m) ** 12 >= 0.999 > 1 - (1 - 0.8 ** (m + 1)) ** 12


def brute_cuts(rows, least, first_stays):
    count: Counter = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + least] for i in range(len(b) - least + 1))
    seen, out = set(), []
    for _, t in rows:
        b = (t or "").encode()
        mask = np.zeros(len(b) + 1, int)
        for i in range(len(b) - least + 1):
            s = b[i : i + least]
            if (s in seen) if first_stays else count[s] > 1:
                mask[i] += 1
                mask[i + least] -= 1
            seen.add(s)
        gone = np.cumsum(mask[:-1]) > 0
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())))
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("hot", [1024, 3, 1])
def test_repeated_strings_match_brute_force(spark, keep_first, hot):
    rows = sorted(((i, t) for i, t in corpus() if i is not None), key=lambda r: r[0])
    docs = table(spark, rows, 1)
    ordered = [(r.doc_id, r.text) for r in docs.withColumn("m", F.monotonically_increasing_id()).orderBy("doc_id", "m").collect()]
    want = brute_cuts(ordered, 200, keep_first)
    got = suffix_dedup.dedup(docs, least=200, keep_first=keep_first, hot=hot)
    assert set(docs.columns) - set(got.columns) == {"_kept"} - set(got.columns)
    assert Counter((r.doc_id, bytes(r["_kept"]), r["_removed"], r["_spans"]) for r in got.collect()) == Counter((i, *w) for (i, _), w in zip(ordered, want, strict=True))


def test_repeated_strings_with_null_ids(docs):
    assert suffix_dedup.dedup(docs, keep_first=True).count() == len(corpus())


@given(st.lists(st.integers(0, 3), min_size=2, max_size=160), st.sampled_from([8, 9, 16]))
@settings(max_examples=120, deadline=None)
def test_longest_previous_factor(values, least):
    data = np.array(values, np.uint8)
    starts = np.arange(max(0, len(data) - least + 1))
    if not len(starts):
        return
    order, lcp = suffix_dedup.suffix_order(data, starts, least)
    hit = np.zeros(len(data), bool)
    hit[order] = suffix_dedup.longest_previous_factor(order, lcp, least) >= least
    body = data.tobytes()
    assert [bool(h) for h in hit[: len(starts)]] == [body[i : i + least] in {body[j : j + least] for j in range(i)} for i in starts]
    hit[:] = False
    hit[order] = suffix_dedup.longest_next_factor(order, lcp, least) >= least
    assert [bool(h) for h in hit[: len(starts)]] == [body[i : i + least] in {body[j : j + least] for j in range(i + 1, len(starts))} for i in starts]


@given(st.lists(st.tuples(st.integers(0, 1 << 20), st.integers(0, 9)), min_size=1, max_size=60, unique_by=lambda x: x[0]))
@settings(max_examples=150, deadline=None)
def test_factor_lengths_are_those_of_the_arrays(suffixes):
    """Any positions and common prefixes: the longest match with a smaller position, within the interval."""
    order, lcp = np.array([p for p, _ in suffixes]), np.array([0, *(n for _, n in suffixes[1:])])
    got = suffix_dedup.longest_previous_factor(order, lcp, 4)
    for i in range(len(order)):
        best = 0
        for j in range(len(order)):
            shared = lcp[min(i, j) + 1 : max(i, j) + 1].min() if i != j else 0
            if order[j] < order[i] and shared >= 4:
                best = max(best, shared)
        assert got[i] == best


def test_hashes_tell_sequences_apart_that_defeat_powers_of_two():
    word = np.zeros(1, np.uint8)
    while len(word) < 2048:
        word = np.concatenate([word, 1 - word])
    got = hashing.ByteHashes(np.concatenate([word, 1 - word]) + np.uint8(97)).ranges(np.array([0, 2048]), np.array([2048, 4096]))
    assert got[0] != got[1]
    data = np.frombuffer(b"abcabc" * 50, np.uint8)
    sums = hashing.ByteHashes(data)
    assert (sums.ranges(np.array([0, 3]), np.array([90, 93]))[0] == sums.ranges(np.array([0, 3]), np.array([90, 93]))[1]) and len(set(sums.windows(30).tolist())) == 3


def brute_quality(text):
    w = (text or "").encode().split()
    threes = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    mark = [False] * len(w)
    for i in range(len(w) - 2):
        if threes[tuple(w[i : i + 3])] > 1:
            mark[i : i + 3] = [True] * 3
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(mark)


def brute_repeats(text, least=10):
    w = (text or "").encode().split()
    longest, mark = 0, [False] * len(w)
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            n = 0
            while j + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= least:
                longest = max(longest, n)
                mark[i : i + n] = [True] * n
                mark[j : j + n] = [True] * n
    return longest, sum(mark)


def test_quality_matches_brute_force(docs):
    got = quality_rules.quality(docs).collect()
    want = Counter()
    for i, t in corpus():
        n, chars, symbols, lines, repeats = brute_quality(t)
        longest, covered = brute_repeats(t) if n < 2000 else (None, None)
        failed = n < 50 or 100 * repeats > 50 * n
        if n < 2000:
            kept = not failed and covered <= 0.3 * n and longest <= min(100, n // 2)
            want[i, n, chars, symbols, lines, repeats, longest, covered, failed, kept] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.longest_repeat, r.covered_words, r.base_failed, r.kept) for r in got if r.n_words < 2000) == want
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in got)


def test_leaks_survive_substitutions(spark, docs):
    item = [f"bench{i}" for i in range(30)]
    changed = [w if i % 5 else f"other{i}" for i, w in enumerate(item)]
    rows = [(1, "before " * 20 + " ".join(item) + " after"), (2, "x " * 9 + " ".join(changed).upper() + " y"), (3, " ".join(item[:9])), (4, None), (None, " ".join(item)), (6, "clean text " * 30)]
    bench = spark.createDataFrame([(7, " ".join(item), "x"), (8, None, "x"), (9, "too short", "x")], "item_id LONG, text STRING, doc_id STRING")
    got = decontamination.overlaps(table(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id, r.equal_words) for r in got} == {(1, 7, 30), (2, 7, 24), (None, 7, 30)}
    kept = decontamination.decontaminate(table(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6]
    far = decontamination.overlaps(table(spark, rows), bench, max_broadcast=0).collect()
    assert Counter(map(tuple, far)) == Counter(map(tuple, got))
    assert decontamination.overlaps(docs, bench).count() == 0


def test_empty_tables(spark):
    none = empty(spark)
    assert jaccard_join.near_duplicates(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0
    assert quality_rules.quality(none).count() == 0
    assert decontamination.overlaps(none, spark.createDataFrame([], "item_id LONG, text STRING")).count() == 0
