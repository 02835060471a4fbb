"""Removal of training documents that hold benchmark passages, by spaced-seed hashing. DataFrame functions only.

Words are runs of letters and digits, lowered. A seed mask names the places of a window that are hashed; the others may
differ, so a hit survives substitutions there. Windows of the benchmark and of the corpus that share a hash give a hit
(document, item, diagonal). Around each hit all words of item and document are compared along the diagonal, and the
best run is taken where an equal word scores 1 and a substituted one -2.

The benchmark's hashes are broadcast only if their measured bytes stay within `max_broadcast`; beyond it Spark shuffles.
Hits are grouped before they meet texts again; they are written once and counted, and broadcast on the same terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MOST_BROADCAST, fresh, sized_broadcast, text_or_empty, written

#: Fixed seed masks: words at 1 are hashed. They let through a substitution in every third, and in every fifth word.
MASKS = ("11011011", "1111011")
SUBSTITUTED = -2


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seed_rows(table: DataFrame, key: str, position: str, masks=MASKS) -> DataFrame:
    """A row (key, seed, position) for each window of each mask.

    Windows are numbered by a generator and hashed after it, so the hashes are compiled with the join that follows.
    """
    hashed = table.select(key, F.transform("words", lambda w: F.xxhash64(w)).alias("hashed")).where(F.size("hashed") >= min(map(len, masks)))
    windows = hashed.select(key, "hashed", F.explode(F.sequence(F.lit(0), F.size("hashed") * len(masks) - 1)).alias("j"))
    windows = windows.select(key, "hashed", F.pmod("j", F.lit(len(masks))).alias("mask"), F.floor(F.col("j") / len(masks)).cast("int").alias(position))
    seed = F.lit(None).cast("long")
    for k, mask in enumerate(masks):
        held = [F.get("hashed", F.col(position) + i) for i, c in enumerate(mask) if c == "1"]
        seed = F.when((F.col("mask") == k) & (F.col(position) + len(mask) <= F.size("hashed")), F.xxhash64(F.lit(k), *held)).otherwise(seed)
    return windows.select(key, seed.alias("seed"), position).where("seed is not null")


def _best_run(flags: Column, start: Column) -> Column:
    """score, length and first place of the best run (Kadane), its first end and its last start where several tie."""
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("now"), F.lit(0).alias("since"), F.lit(0).alias("score"), F.lit(0).alias("length"), F.lit(0).alias("first"))

    def step(a: Column, same: Column) -> Column:
        gain = F.when(same, F.lit(1)).otherwise(F.lit(SUBSTITUTED))
        fresh = a["now"] <= 0
        now = F.when(fresh, gain).otherwise(a["now"] + gain)
        since = F.when(fresh, a["i"]).otherwise(a["since"])
        up = now > a["score"]
        return F.struct(
            (a["i"] + 1).alias("i"), now.alias("now"), since.alias("since"), F.when(up, now).otherwise(a["score"]).alias("score"),
            F.when(up, a["i"] - since + 1).otherwise(a["length"]).alias("length"), F.when(up, since).otherwise(a["first"]).alias("first"),
        )

    return F.aggregate(flags, zero, step, lambda a: F.struct(a["score"].alias("score"), a["length"].alias("length"), (a["first"] + start).alias("item_start")))


def overlaps(docs: DataFrame, benchmark: DataFrame, *, masks=MASKS, least: int = 12, max_broadcast: int = MOST_BROADCAST, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """The best verified overlap of each document with each benchmark item.

    doc_id, item_id, score, length (words), equal_words, doc_start, item_start (in words), for scores of `least` or
    more; an item of fewer words must be met but for one substitution. An item of fewer words than the shortest mask has no
    seed and is never found, nor is a passage in which every fourth word is changed. Null and empty texts have no words; null ids are
    kept and match as equal; rows that repeat an id count as one document; other columns are ignored; empty tables give
    no rows.
    """
    corpus = docs.select(F.col(id_column).cast("long").alias("doc_id"), words(text_or_empty(text_column)).alias("words"))
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), words(text_or_empty("text")).alias("words"))
    item_seeds = sized_broadcast(written(seed_rows(items, "item_id", "item_place", masks), "seeds"), max_broadcast)
    hits = seed_rows(corpus, "doc_id", "doc_place", masks).join(item_seeds, "seed")
    hits = written(hits.groupBy("doc_id", "item_id", (F.col("doc_place") - F.col("item_place")).alias("diagonal")).agg(F.count("*").alias("seeds")), "hits")
    hits = sized_broadcast(hits, max_broadcast)
    items = sized_broadcast(items.withColumnRenamed("words", "item_words"), max_broadcast)
    pairs = corpus.join(hits.withColumnRenamed("doc_id", "hit_id"), F.col("doc_id").eqNullSafe(F.col("hit_id"))).join(items, "item_id")
    low = F.greatest(F.lit(0), -F.col("diagonal"))
    high = F.least(F.size("item_words"), F.size("words") - F.col("diagonal")) - 1
    flags = F.transform(F.sequence(low, high), lambda i: F.get("words", i + F.col("diagonal")) == F.get("item_words", i))
    run = F.when(high >= low, _best_run(flags, low))
    found = pairs.select("doc_id", "item_id", "diagonal", F.size("item_words").alias("m"), run.alias("run")).select("doc_id", "item_id", "m", "run.score", "run.length", (F.col("run.item_start") + F.col("diagonal")).alias("doc_start"), "run.item_start")
    needed = F.least(F.lit(least), F.col("m") + SUBSTITUTED - 1)
    best = found.where((F.col("score") >= needed) & (F.col("score") > 0)).groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "length", "doc_start", "item_start")).alias("b"))
    return best.select("doc_id", "item_id", "b.score", "b.length", ((F.col("b.score") + 2 * F.col("b.length")) / 3).cast("int").alias("equal_words"), "b.doc_start", "b.item_start")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no benchmark passage, with all their columns; see `overlaps`."""
    key = options.get("id_column", "doc_id")
    leak = fresh(docs, "_leak")
    leaks = written(overlaps(docs, benchmark, **options).select(F.col("doc_id").alias(leak)).distinct(), "leaks")
    leaks = sized_broadcast(leaks, options.get("max_broadcast", MOST_BROADCAST))
    return docs.join(leaks, docs[key].cast("long").eqNullSafe(leaks[leak]), "left_anti")


def op5_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM documents),
iw AS (SELECT item_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM benchmark),
ds AS (
  SELECT doc_id, p, 0 AS mask, concat_ws(' ', w[p], w[p+1], w[p+3], w[p+4], w[p+6], w[p+7]) AS seed FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM dw WHERE len(w) >= 8)
  UNION ALL
  SELECT doc_id, p, 1, concat_ws(' ', w[p], w[p+1], w[p+2], w[p+3], w[p+5], w[p+6]) FROM (SELECT doc_id, w, unnest(range(1, len(w) - 5)) AS p FROM dw WHERE len(w) >= 7)),
bs AS (
  SELECT item_id, p, 0 AS mask, concat_ws(' ', w[p], w[p+1], w[p+3], w[p+4], w[p+6], w[p+7]) AS seed FROM (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS p FROM iw WHERE len(w) >= 8)
  UNION ALL
  SELECT item_id, p, 1, concat_ws(' ', w[p], w[p+1], w[p+2], w[p+3], w[p+5], w[p+6]) FROM (SELECT item_id, w, unnest(range(1, len(w) - 5)) AS p FROM iw WHERE len(w) >= 7)),
hits AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS d FROM ds JOIN bs USING (mask, seed)),
flags AS (
  SELECT h.doc_id, h.item_id, h.d, len(iw.w) AS m, i, CASE WHEN dw.w[i + d + 1] = iw.w[i + 1] THEN 1 ELSE -2 END AS g
  FROM hits h JOIN dw ON dw.doc_id = h.doc_id JOIN iw ON iw.item_id = h.item_id,
  unnest(range(greatest(0, -d), least(len(iw.w), len(dw.w) - d))) AS u(i)),
sums AS (SELECT *, sum(g) OVER (PARTITION BY doc_id, item_id, d ORDER BY i) AS s FROM flags),
bases AS (SELECT *, s - g AS before FROM sums),
lows AS (SELECT *, min(before) OVER (PARTITION BY doc_id, item_id, d ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low FROM bases),
tops AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, d ORDER BY s - low DESC, i) AS r FROM lows),
ends AS (SELECT doc_id, item_id, d, m, i AS stop, s - low AS score, low FROM tops WHERE r = 1),
runs AS (
  SELECT e.doc_id, e.item_id, e.m, e.score, e.d, e.stop, max(b.i) AS first
  FROM ends e JOIN bases b ON b.doc_id = e.doc_id AND b.item_id = e.item_id AND b.d = e.d AND b.i <= e.stop AND b.before = e.low
  WHERE e.score > 0 AND e.score >= least(12, e.m - 3) GROUP BY ALL),
ranked AS (SELECT *, stop - first + 1 AS length, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, stop - first + 1 DESC, first + d DESC, first DESC) AS r FROM runs)
SELECT doc_id, item_id, CAST(score AS INT) AS score, CAST(length AS INT) AS length, CAST((score + 2 * length) / 3 AS INT) AS equal_words,
       CAST(first + d AS INT) AS doc_start, CAST(first AS INT) AS item_start
FROM ranked WHERE r = 1
"""
