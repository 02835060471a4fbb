"""Scoring, sharding, pages and the pipeline."""

from __future__ import annotations

import functools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brume.llm import html_extraction, lm_scoring, sharding

from .texts import corpus, empty, table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus())


def words(text):
    return [w.lower() for w in (text or "").encode().split()] + [None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def brute_scores(rows):
    one, two = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = words(t)
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v = sum(one.values()), len(one)
    kinds = lambda c: [Counter(c.values())[r] for r in range(1, 7)]
    d1, d2 = lm_scoring.good_turing(kinds(one)), lm_scoring.good_turing(kinds(two))
    cut = lambda c, d: (d[c] if c <= 5 else 1.0) * c
    unknown = 1 - sum(cut(c, d1) for c in one.values()) / n
    p = lambda w: cut(one[w], d1) / n if one[w] else unknown
    after = defaultdict(list)
    for (h, w), c in two.items():
        after[h].append((w, c))
    weight = {}
    for h, f in after.items():
        count, seen = sum(c for _, c in f), sum(cut(c, d2) for _, c in f)
        divisor = count if count - seen > 1e-9 * count else count + 1
        weight[h] = (divisor, (1 - seen / divisor) / (1 - sum(p(w) for w, _ in f)))
        assert abs(sum(cut(c, d2) / divisor for _, c in f) + weight[h][1] * (1 - sum(p(w) for w, _ in f)) - 1) < 1e-9
    out = []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((one[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = 0.0
        for h, x in zip(["<s>", *w[:-1]], w, strict=True):
            c = two[h, x]
            score += math.log10(cut(c, d2) / weight[h][0]) if c else math.log10((weight[h][1] if h in weight else 1) * p(x))
        out.append((i, held(i), len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(score, 6)))
    return Counter(out)


def test_scores_match_brute_force(docs):
    got = lm_scoring.score(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == brute_scores(corpus())


def test_scores_beat_the_base_on_held_out_texts(spark):
    rows = [(i, "the cat sat on the mat and the dog ran " * (i % 4 + 1)) for i in range(120)]
    got = [r for r in lm_scoring.score(table(spark, rows)).collect() if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)


def brute_orders(rows, order):
    """(doc_id, score) by the recursion itself."""
    counts = [Counter() for _ in range(order + 1)]
    texts = [(i, ["<s>"] * (order - 1) + words(t)) for i, t in rows]
    for i, w in texts:
        if not held(i):
            for m in range(1, order + 1):
                counts[m].update(tuple(w[k - m + 1 : k + 1]) for k in range(order - 1, len(w)))
    discounts = [lm_scoring.good_turing([Counter(c.values())[r] for r in range(1, 7)]) for c in counts]
    cut = lambda c, m: (discounts[m][c] if c <= 5 else 1.0) * c
    n = sum(counts[1].values())
    after = defaultdict(list)
    for m in range(2, order + 1):
        for g, c in counts[m].items():
            after[g[:-1]].append((g[-1], c))
    seen_words = sum(cut(c, 1) for c in counts[1].values())
    n += n - seen_words < 1e-9 * n
    unknown = 1 - seen_words / n

    @functools.cache
    def weight(h):
        count, seen = sum(c for _, c in after[h]), sum(cut(c, len(h) + 1) for _, c in after[h])
        divisor = count if count - seen > 1e-9 * count else count + 1
        return divisor, (1 - seen / divisor) / (1 - sum(p(h[1:], w) for w, _ in after[h]))

    @functools.cache
    def p(h, w):
        c = counts[len(h) + 1][(*h, w)]
        if not h:
            return cut(c, 1) / n if c else unknown
        if h not in after:
            return p(h[1:], w)
        return cut(c, len(h) + 1) / weight(h)[0] if c else weight(h)[1] * p(h[1:], w)

    return Counter((i, round(sum(math.log10(p(tuple(w[k - order + 1 : k]), w[k])) for k in range(order - 1, len(w))), 5)) for i, w in texts)


@pytest.mark.parametrize("order", [1, 3, 4])
def test_scores_of_any_order_match_brute_force(spark, order):
    rows = [(i, " ".join(random.Random(i).choices("a b c d e f g".split() + [f"w{k}" for k in range(9)], weights=[9] * 7 + [1] * 9, k=i % 40))) for i in range(160)] + [(None, None)]
    got = lm_scoring.score(table(spark, rows), order=order).collect()
    assert Counter((r.doc_id, round(r.score, 5)) for r in got) == brute_orders(rows, order)


@pytest.mark.parametrize("options", [{"bucket_tokens": 40, "fan_bits": 2}, {"block_bytes": 300, "bucket_tokens": 100, "fan_bits": 1, "hot": 5}, {"hot": 1}])
def test_scores_by_many_buckets_and_split_contexts(spark, options):
    """Units merged in groups in several steps, blocks of a text or two, and most contexts split."""
    rows = [(i, " ".join(random.Random(i).choices("a b c d e f g".split() + [f"w{k}" for k in range(9)], weights=[9] * 7 + [1] * 9, k=i % 40))) for i in range(160)] + [(None, None)]
    got = lm_scoring.score(table(spark, rows), order=3, **options).collect()
    assert Counter((r.doc_id, round(r.score, 5)) for r in got) == brute_orders(rows, 3)


def test_what_is_merged_is_about_as_large_as_a_unit(spark, monkeypatch):
    """More buckets than one cut makes: no group of requests grows with the number of units."""
    rows = [(i, " ".join(f"w{random.Random(i).randrange(4000) + k}" for k in range(60))) for i in range(160)]
    groups, by = Counter(), lm_scoring._by

    def noted(df, *keys):
        if keys == ("bucket", "to"):
            for r in df.where(F.col("kind") == lm_scoring.ASK).select(*keys, "parts").collect():
                groups[r.bucket, r.to] += len(lm_scoring._unpack(bytes(r.parts[2])))
        return by(df, *keys)

    monkeypatch.setattr(lm_scoring, "_by", noted)
    got = lm_scoring.score(table(spark, rows), order=1, block_bytes=1, bucket_tokens=16)
    asked = sum(groups.values())
    assert asked >= 160 * 61 and max(groups.values()) <= 4 * asked / 160
    assert Counter((r.doc_id, round(r.score, 5)) for r in got.collect()) == brute_orders(rows, 1)


@pytest.mark.parametrize("values", [[], [0], [5, 0, 0, 300, 70_000, 1, 2, 16_777_216], list(range(3000))])
def test_codes_are_packed_without_loss(values):
    values = np.array(values, np.int64)
    assert lm_scoring._unpack_codes(lm_scoring._pack_codes(values)).tolist() == values.tolist()
    assert lm_scoring._unpack(lm_scoring._pack(values - 7)).tolist() == (values - 7).tolist()


def test_requests_are_handed_on_together_and_packed_short():
    """Rows of one block go on in one batch, equal values take no bytes, and rising numbers about a byte a step."""
    words = pa.array([b"w%d" % i for i in range(2000)], pa.large_binary())
    row = {"kind": lm_scoring.WORDS, "order": 0, "unit": 5, "parts": [*lm_scoring._pack_bytes(words), lm_scoring._pack(np.ones(2000, np.int64))]}
    got = list(lm_scoring._ask_words(lm_scoring.Cut(7, 7))(iter([lm_scoring._rows([row])])))
    assert len(got) == 1 and got[0].num_rows == 128 and set(got[0].column("unit").to_pylist()) == {5}
    assert len(lm_scoring._pack(np.full(100_000, 1 << 45))) < 32
    rising = (1 << 45) + np.cumsum(np.random.default_rng(0).integers(0, 256, 5000))
    assert len(lm_scoring._pack_steps(rising)) < 6000
    for values in (rising, rising[:1], rising[:0], np.array([-1, 1 << 62, -(1 << 62), -1])):
        assert lm_scoring._unpack_steps(lm_scoring._pack_steps(values)).tolist() == values.tolist()
        assert lm_scoring._unpack(lm_scoring._pack(values)).tolist() == values.tolist()
    for values in (np.array([0.0, -1.5, 1e-9]), np.zeros(0)):
        assert lm_scoring._unpack(lm_scoring._pack(values), np.float64).tolist() == values.tolist()
    large = np.array([(1 << 54) - 1, 1 << 54, (1 << 62) - 1, 0, 1])
    assert lm_scoring._unpack_codes(lm_scoring._pack_codes(large)).tolist() == large.tolist()


def test_words_are_told_apart_by_themselves(spark):
    """Two words that any polynomial modulo 2**64 confuses: one trains, the other is held out."""
    one = "a"
    while len(one) < 1024:
        one += one.translate({97: "b", 98: "a"})
    other = one.translate({97: "b", 98: "a"})
    first, second = next(i for i in range(99) if not held(i)), next(i for i in range(99) if held(i))
    got = {r.doc_id: r for r in lm_scoring.score(table(spark, [(first, one), (second, other)])).collect()}
    assert (got[first].n_known, got[second].n_known) == (2, 1)


def test_texts_of_more_than_a_block(spark):
    rows = [(i, " ".join(random.Random(i).choices("a b c d e f g h".split(), k=3000 if i % 3 else 60))) for i in range(20)]
    got = lm_scoring.score(table(spark, rows), order=3, block_bytes=1000).collect()
    assert Counter((r.doc_id, round(r.score, 4)) for r in got) == Counter((i, round(x, 4)) for i, x in [(k[0], k[1]) for k in brute_orders(rows, 3)])


def test_query_scores_trigrams(spark, tmp_path):
    table(spark, corpus()).write.parquet(f"{tmp_path}/documents.parquet")
    got = lm_scoring.op10_lm_scoring(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, round(r.score, 5)) for r in got) == brute_orders(corpus(), 3)


def test_scores_without_training_texts(spark):
    rows = [(i, "some words") for i in range(400) if held(i)]
    got = lm_scoring.score(table(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.train_tokens == 0 and r.base_score == 0 and r.score == 0 for r in got)
    assert lm_scoring.score(empty(spark)).count() == 0


@pytest.mark.parametrize("per_block", [65_536, 1])
def test_shards_are_a_permutation_of_exact_sizes(docs, per_block):
    got = sharding.shuffle_into_shards(docs, shards=7, rows_per_block=per_block).select("doc_id", "text", "_shard", "_slot").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(corpus())
    sizes = Counter(r["_shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(7))
    for s in sizes:
        assert sorted(r["_slot"] for r in got if r["_shard"] == s) == list(range(sizes[s]))


def test_shards_are_uniform(spark):
    rows = [(i, "t") for i in range(40)]
    docs = table(spark, rows, 2)
    seen = Counter()
    for seed in range(30):
        seen.update((r.doc_id, r["_shard"]) for r in sharding.shuffle_into_shards(docs, shards=2, seed=seed).collect())
    assert all(4 <= seen[i, 0] <= 26 for i in range(40))


def test_communication_matrix_margins():
    counts = {0: 10, 3: 1, 7: 0, 9: 34}
    m = sharding.communication_matrix(counts, 4, 1)
    assert {p: int(a.sum()) for p, a in m.items()} == counts
    columns = sum(m.values())
    assert columns.max() - columns.min() <= 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">{0} menu</a></li></ul></nav><div class="cookieNotice">We use cookies {0}</div><div class=sidebar><p>Side {0} text that is long enough to count</p></div>
<div id="main"><div class="post"><h1>Title {0}</h1><p>One &amp; two<br>three&nbsp;{0}<p><b>Unclosed <i>bold {0}<ul><li>first {0}</li><li>second</li></ul><blockquote>Quote {0}</blockquote><form><p>Sign up</p></form><p>Share this page with friends</p></div>
<section id="comments"><p>Nice post {0}!</p></section></div><!-- gone {0} --><footer>&copy; {0}</footer></body></html>"""


def test_pages_give_their_article(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(f"n{i}")) for i in range(5)]
    rows += [(10, "https://b.example:80/x", "<html><body><article><h1>Only</h1><p>One page</p></article><footer>f</footer>"), (11, None, None), (12, "nohost", ""), (13, "http://c.example", "<p>cut in the mid"), (None, "http://b.example", "plain text")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id LONG, url STRING, html STRING, host STRING").repartition(3).checkpoint()
    for limit in (10_000, 0):
        got = {r.page_id: r for r in html_extraction.extract(pages, max_broadcast=limit).collect()}
        assert len(got) == len(rows)
        for i in range(5):
            body = got[i].text.split("\n")
            assert body[:6] == [f"Title n{i}", f"One & two three n{i}", f"Unclosed bold n{i}", f"first n{i}", "second", f"Quote n{i}"]
            assert not any(x in got[i].text for x in ("menu", "cookies", "Side", "Sign", "Nice", "©", "Site", "gone"))
        assert got[10].text == "Only\nOne page" and got[11].text == "" and got[12].text == "" and got[13].text == "cut in the mid" and got[None].text == "plain text"
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extraction.extract(spark.createDataFrame([], pages.schema)).count() == 0


def test_wrappers_merge_in_any_order():
    pages = [html_extraction.wrapper_of(html_extraction.parse(PAGE.format(f"n{i}"))) for i in range(4)]
    left = html_extraction._merged(html_extraction._merged(pages[0], pages[1]), html_extraction._merged(pages[2], pages[3]))
    right = html_extraction._merged(pages[3], html_extraction._merged(pages[2], html_extraction._merged(pages[1], pages[0])))
    assert html_extraction.main_slots(left) == html_extraction.main_slots(right)


def texts_of(pages):
    """The main text of each page of one host."""
    wrapper = functools.reduce(html_extraction._merged, (html_extraction.wrapper_of(html_extraction.parse(p)) for p in pages))
    return ["\n".join(html_extraction.blocks(html_extraction.parse(p), html_extraction.main_slots(wrapper))) for p in pages]


def test_every_layout_of_a_host_keeps_its_text():
    pages = [f'<body><nav><p>Menu</p></nav><div class="{"post" if i % 10 < 7 else "entry"}"><p>{f"Text{i} " * 40}</p></div></body>' for i in range(20)]
    pages.append('<body><div class="big"><p>' + "huge " * 30_000 + "</p></div></body>")
    assert all(t and t == html_extraction.parse(p).children[0].children[-1].children[0].children[0][0] for p, t in zip(pages, texts_of(pages), strict=True))


@pytest.mark.parametrize("outer, one, two", [("article", 'div class="lead"', 'div class="content"'), ("div", 'div class="lead"', 'div class="content"'), ("main", "section", "section")])
def test_all_parts_of_an_article_are_kept(outer, one, two):
    for many in (30, 65):
        pages = [f"<body><{outer}><{one}><p>{f'a{i} ' * many}</p></{one.split()[0]}><{two}><p>{f'b{i} ' * (100 - many)}</p></{two.split()[0]}></{outer}></body>" for i in range(6)]
        assert all(f"a{i}" in t and f"b{i}" in t for i, t in enumerate(texts_of(pages)))


def test_copies_of_a_page_are_no_template():
    page = "<body><div><p>{0}</p>{1}<h6>Same on all pages</h6></div></body>"
    for others in (1, 20):
        pages = [page.format("Copied text", "<blockquote>Copied quote</blockquote>")] * 3 + [page.format(f"Text {i}", "") for i in range(others)]
        got = texts_of(pages)
        assert all("Copied text\nCopied quote" in t for t in got[:3])
        assert others == 1 or not any("Same" in t for t in got)


def test_a_page_of_template_text_is_not_empty():
    pages = ["<body><div><h6>Same on all pages</h6></div></body>"] + [f"<body><div><h6>Same on all pages</h6><p>Text {i}</p></div></body>" for i in range(5)]
    assert texts_of(pages) == ["Same on all pages", *(f"Text {i}" for i in range(5))]


def test_generated_pages_give_their_blocks():
    """Hosts with furniture, titles and blocks of their own; what each page was made of is what comes out."""
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n))
    for _ in range(12):
        around, nav, foot = rng.choice(["article", 'div class="post"', 'div id="content"', "main"]), words(6), words(9)
        side, comment = rng.random() < 0.6, rng.random() < 0.6
        pages, want = [], []
        for _ in range(rng.randint(4, 14)):
            blocks = [words(5), *(words(rng.randint(8, 60)) for _ in range(rng.randint(1, 9)))]
            tags = ["h1", *rng.choices(["p", "blockquote", "pre", "p"], k=len(blocks) - 1)]
            body = "\n  ".join(f"<{t}>{x.replace(' ', rng.choice([' ', '  ', chr(10)]), 3)}</{t}>" for t, x in zip(tags, blocks, strict=True))
            page = f"<html><head><title>{words(3)}</title><style>p {{}}</style></head><body><header><p>{nav}</p></header><nav><ul><li><a href=/>{nav}</a></li></ul></nav><{around}>{body}</{around.split()[0]}>"
            page += f"<aside><p>{words(9)}</p></aside>" * side + f'<div class="comments"><p>{words(12)}</p></div>' * comment + f"<script>var x = '{words(4)}';</script><footer><p>{foot}</p></footer></body></html>"
            pages.append(page)
            want.append("\n".join(blocks))
        assert texts_of(pages) == want


def test_deeply_nested_pages():
    page = "<body>" + "<div>" * 10_000 + "<p>Deep {0}</p><div class=ad>buy<div>more</div></div>tail {0}" + "</div>" * 10_000 + "<p>After {0}</p></body>"
    assert texts_of([page.format(i) for i in range(4)]) == [f"Deep {i}\ntail {i}\nAfter {i}" for i in range(4)]


def test_alignment_is_a_longest_common_subsequence():
    for k in range(300):
        rng = random.Random(k)
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 12))) for _ in range(2))
        pairs = html_extraction._aligned(list(a), list(b))
        assert [i for i, _ in pairs if i >= 0] == list(range(len(a))) and [j for _, j in pairs if j >= 0] == list(range(len(b)))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        assert all(a[i] == b[j] for i, j in pairs if i >= 0 <= j) and sum(i >= 0 <= j for i, j in pairs) == best[0][0]


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    bench = " ".join(f"bench{i}" for i in range(30))
    rows = [*corpus(), (900, "start " + bench + " " + " ".join(f"u{i}" for i in range(60)))]
    plain = table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id LONG, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, str(tmp_path)).checkpoint()
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == plain.columns
            assert docs.where("n_chars <> char_length(text)").count() == 0
        if name == "benchmark decontamination":
            assert before.where("doc_id = 900").count() == 1 and docs.where("doc_id = 900").count() == 0
            assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > sizes[4]
    tokens = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert tokens.where("n % m <> 0").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == sizes[5]
    extra = table(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, str(tmp_path)).columns == extra.columns, name
