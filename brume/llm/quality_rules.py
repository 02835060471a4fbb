"""Quality rules for whole texts, with repetition measured on a suffix array.

Suffixes of the word sequences of many documents are sorted together by prefix doubling; the first sort key holds the
document, so suffixes of different documents never share a prefix. The longest common prefix of neighbours in that
order gives, for each word, the longest repeated substring that starts there: the maximal intervals. Those of `least`
words or more are repeats; the union of their spans is the covered part of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, is_space, slices, text_bytes, text_or_empty, word_starts

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "longest_repeat long, covered_words long, base_failed boolean, kept boolean"
)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def suffix_array(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes and their ranks by the first 1, 2, 4, ... symbols.

    `codes` holds the symbols of all sequences, `at` their n + 1 offsets. Sequences never mix; ends sort first.
    """
    n = len(codes)
    seq = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    stop = np.repeat(at[1:], np.diff(at))
    key = seq << 32 | codes.astype(np.int64)
    order = np.argsort(key, kind="stable")
    heads = np.concatenate([[True], np.diff(key[order]) != 0]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0)) if n else 0
    ranks, h = [rank.astype(np.int32)], 1
    while n:
        first = np.flatnonzero(heads)
        size = np.diff(np.append(first, n))
        active = np.repeat(size > 1, size)  # places in the order whose suffixes still tie
        if not active.any():
            break
        where = np.flatnonzero(active)
        who = order[where]
        ahead = who + h
        second = np.where(ahead < stop[who], rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[who]))
        who, second = who[by], second[by]
        order[where] = who
        lead = rank[who]
        fresh = np.concatenate([[True], (np.diff(lead) != 0) | (np.diff(second) != 0)])
        heads[where] |= fresh
        new = np.where(fresh, where, 0)
        rank = rank.copy()
        rank[who] = np.maximum.accumulate(new)
        ranks.append(rank.astype(np.int32))
        h *= 2
    return order, ranks


def neighbour_lcp(order: np.ndarray, ranks: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix in the order with the one before it (0 for the first)."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    stop = np.repeat(at[1:], np.diff(at))
    pair = np.flatnonzero(np.diff(ranks[0][order]) == 0) + 1
    a, b = order[pair - 1], order[pair]
    got = np.zeros(len(pair), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        # equal ranks mean equal prefixes only where both suffixes are long enough, or the same
        x, y = a + got, b + got
        ok = (x + (1 << level) <= stop[a]) & (y + (1 << level) <= stop[b])
        same = ok & (ranks[level][np.minimum(x, n - 1)] == ranks[level][np.minimum(y, n - 1)])
        got += np.where(same, 1 << level, 0)
    lcp[pair] = got
    return lcp


def repeat_lengths(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place the length of the longest substring that starts there and occurs twice or more in its sequence."""
    order, ranks = suffix_array(codes, at)
    lcp = neighbour_lcp(order, ranks, at)
    best = np.zeros(len(codes), np.int64)
    best[order] = np.maximum(lcp, np.append(lcp[1:], 0)) if len(codes) else 0
    return best


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Mask of the places in the union of spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def _per_text(mask_or_values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask_or_values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _measure(data: np.ndarray, at: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """`data`: texts that each end with a line feed of their own."""
    n = len(at) - 1
    space = is_space(data)
    starts = np.flatnonzero(word_starts(data, at, space))
    first = np.searchsorted(starts, at)
    n_words = np.diff(first)
    out = {"n_words": n_words, "word_chars": _per_text(~space & (data & 0xC0 != 0x80), at), "n_symbols": _per_text(SYMBOLS[data], at)}

    feeds = np.flatnonzero(data == 10) + 1
    begins = np.concatenate([[0], feeds])[: len(feeds)]
    has_word = np.searchsorted(starts, feeds) > np.searchsorted(starts, begins)
    lines = slices(data, np.concatenate([[0], feeds])).dictionary_encode().indices.to_numpy(zero_copy_only=False)[has_word].astype(np.int64)
    owner = np.searchsorted(at, begins[has_word], "right") - 1
    distinct = np.unique(owner << 32 | lines) >> 32
    out["n_dup_lines"] = np.bincount(owner, minlength=n) - np.bincount(distinct, minlength=n)

    if len(starts):
        # the white space after a word does not count: it is put to one kind, and runs of it are cut off
        kept = ~space
        kept[1:] |= ~space[:-1]
        plain = np.where(space, np.uint8(32), data)[kept]
        where = np.cumsum(kept) - 1
        codes = slices(plain, np.append(where[starts], len(plain))).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    else:
        codes = np.zeros(0, np.int64)
    best = repeat_lengths(codes, first)
    three = np.flatnonzero(best >= 3)
    out["n_repeat_words"] = _per_text(covered(three, np.full(len(three), 3), len(codes)), first)
    long = np.flatnonzero(best >= least)
    out["covered_words"] = _per_text(covered(long, best[long], len(codes)), first)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, np.searchsorted(first, long, "right") - 1, best[long])
    out["longest_repeat"] = longest
    return out


def _verdicts(texts: pa.Array, least: int, most_covered: float, most_longest: int) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """Ranges of rows with their measures, `base_failed` and `kept`."""
    texts = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    data, at = text_bytes(texts)
    for a, b in byte_groups(np.diff(at), 1 << 20):
        m = _measure(data[at[a] : at[b]], at[a : b + 1] - at[a], least)
        m["base_failed"] = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        m["kept"] = ~m["base_failed"] & (m["covered_words"] <= most_covered * m["n_words"]) & (m["longest_repeat"] <= np.minimum(most_longest, m["n_words"] // 2))
        yield a, b, m


def quality(docs: DataFrame, *, least: int = 10, most_covered: float = 0.3, most_longest: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and a verdict for every row: see SCHEMA.

    `base_failed`: fewer than 50 words, or over half of them in 3-word windows that repeat. `kept`: not so, and repeats
    of `least` words or more cover at most `most_covered` of the words, none longer than `most_longest` words or half
    the text. Null and empty texts have no words and fail; null ids and repeated rows are kept; other columns are
    ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "covered_words"]
        for batch in batches:
            for a, b, m in _verdicts(batch.column(1), least, most_covered, most_longest):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(m[k], pa.int64()) for k in names), pa.array(m["base_failed"]), pa.array(m["kept"])], names=["doc_id", *names, "base_failed", "kept"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, *, least: int = 10, most_covered: float = 0.3, most_longest: int = 100, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that `quality` keeps, with all their columns and without a join."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, m in _verdicts(batch.column(place), least, most_covered, most_longest):
                yield batch.slice(a, b - a).filter(pa.array(m["kept"]))

    return docs.mapInArrow(run, docs.schema)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
