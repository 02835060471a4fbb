"""Exact token counts of whole texts by overlap resynchronisation.

Every text is cut into overlapping chunks, each encoded with the places of its tokens. Two neighbouring encodings are
spliced at a stable boundary in their overlap: a single space between two characters that are no white space. The
byte-level pre-tokenizer always starts a piece there, whatever came before, so what follows is the same in both
encodings. The splice also checks this: from the boundary to the last one in the overlap both must give the same ids.
Where the overlap holds no such boundary, or the check fails, the overlap is doubled, up to the whole text.

Chunks of many texts are encoded together by their units (see `common.UnitEncoder`), which gives the places of the units,
so of all boundaries. Texts that need a wider overlap, or that hold white space beside the ASCII kind, are encoded chunk
by chunk by the library itself, with the offsets of its tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_MODEL, UnitEncoder, byte_groups, is_space, load_tokenizer, text_bytes, text_or_empty, tokenizer_path, unit_encoder

BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
#: White space beside the ASCII kind, and controls that some libraries take for it.
OTHER_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class _Chunk:
    def __init__(self, start: int, encoding):
        self.start = start
        self.ids = np.asarray(encoding.ids, np.int64)
        self.ends = np.asarray([e for _, e in encoding.offsets], np.int64) + start

    def before(self, place: int) -> int:
        """Tokens that end at or before a boundary."""
        return int(np.searchsorted(self.ends, place, "right"))


def splice(text: str, left: _Chunk, right: _Chunk, stop: int) -> int | None:
    """The first proven common boundary in the overlap [right.start, stop), or None."""
    places = [m.start() for m in BOUNDARY.finditer(text, right.start + 1, stop - 1)]
    if not places:
        return None
    first, last = places[0], places[-1]
    a = left.ids[left.before(first) : left.before(last)]
    b = right.ids[right.before(first) : right.before(last)]
    return first if np.array_equal(a, b) else None


def count_huge(tokenizer, text: str, chunk: int = 8192, overlap: int = 128) -> int:
    """Tokens of one text, by chunks; equal to the length of the encoding of the whole text."""

    def encoded(a: int, b: int) -> _Chunk:
        return _Chunk(a, tokenizer.encode(text[a:b], add_special_tokens=False))

    def counted(part: _Chunk) -> int:
        return part.before(begin) if begin else 0

    total, begin, stop = 0, 0, min(len(text), chunk + overlap)
    left = encoded(0, stop)
    while stop < len(text):
        width, place, start = overlap, None, stop
        after = min(len(text), stop + chunk)
        while place is None and start > begin + 1:
            start = max(begin + 1, stop - width)
            right = encoded(start, after)
            place = splice(text, left, right, stop)
            width *= 2
        if place is None:  # no boundary in all of the left chunk: it grows
            stop = min(len(text), left.start + 2 * (stop - left.start))
            left = encoded(left.start, stop)
            continue
        total += left.before(place) - counted(left)
        left, begin, stop = right, place, after
    return total + len(left.ids) - counted(left)


class _Chunks:
    """Overlapping chunks of some texts, one after the other in `data`: own text, place in it, and place in `data` (n + 1)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, chunk: int, overlap: int):
        size = np.diff(at)
        n = np.maximum(1, -(-(size - overlap) // chunk))
        self.text = np.repeat(np.arange(len(size)), n)
        self.first = np.cumsum(n) - n
        self.start = (np.arange(len(self.text)) - self.first[self.text]) * chunk
        stop = np.minimum(size[self.text], self.start + chunk + overlap)
        last = self.first + n - 1
        stop[last] = size
        for edge in (self.start, stop):  # no character is split
            for _ in range(3):
                inside = np.flatnonzero((edge > 0) & (edge < size[self.text]))
                edge[inside] -= (data[at[self.text[inside]] + edge[inside]] & 0xC0) == 0x80
        self.stop = stop
        self.at = np.concatenate([[0], np.cumsum(stop - self.start)])
        base = at[self.text]
        self.data = data if len(n) == len(self.text) else np.concatenate([data[a:b] for a, b in zip((base + self.start).tolist(), (base + stop).tolist(), strict=True)])


def _counted(encoder: UnitEncoder, data: np.ndarray, at: np.ndarray, chunk: int, overlap: int) -> np.ndarray:
    """Tokens of each text; -1 where two chunks could not be spliced."""
    parts = _Chunks(data, at, chunk, overlap)
    ids, before, cuts, total = encoder.encode_chunks(parts.data, parts.at)
    n, failed = np.zeros(len(at) - 1, np.int64), np.zeros(len(at) - 1, bool)
    np.add.at(n, parts.text, np.diff(before))
    space = is_space(parts.data)
    for right in np.flatnonzero(parts.start > 0).tolist():
        left, text = right - 1, parts.text[right]
        begin, shared = parts.at[right], parts.stop[left] - parts.start[right]
        places = cuts[np.searchsorted(cuts, begin + 1) : np.searchsorted(cuts, begin + shared - 1)]
        places = places[(parts.data[places] == 32) & ~space[places - 1] & ~space[places + 1]]
        if not len(places):
            failed[text] = True
            continue
        here = places[[0, -1]]
        there = here - begin + parts.at[left] + parts.start[right] - parts.start[left]
        one, two = np.searchsorted(cuts, there), np.searchsorted(cuts, here)
        if (cuts[one] != there).any() or not np.array_equal(ids[total[one[0]] : total[one[1]]], ids[total[two[0]] : total[two[1]]]):
            failed[text] = True
            continue
        n[text] -= (before[right] - total[one[0]]) + (total[two[0]] - before[right])  # what the left one has after the boundary, the right one before it
    return np.where(failed, -1, n)


def token_counts(
    docs: DataFrame, *, tokenizer: str | None = None, limit: int = 1024, chunk: int = 8192, overlap: int = 128, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    Null and empty texts have 0 bytes and 0 tokens; null ids and repeated rows are kept; other columns are ignored;
    an empty table gives no rows. Special strings in a text count as the tokenizer's special tokens (its default).
    Chunks have `chunk` bytes and `overlap` bytes more.
    """
    path = tokenizer or tokenizer_path(BYTE_MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, plain = unit_encoder(path, words=False), load_tokenizer(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            data, at = text_bytes(texts)
            size = np.diff(at)
            odd = pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False)
            n = np.full(len(size), -1, np.int64)
            for a, b in byte_groups(np.where(odd, 0, size), 2 << 20):
                usual = np.flatnonzero(~odd[a:b])
                own, begin = data[at[a] : at[b]], at[a : b + 1] - at[a]
                if len(usual) < b - a:
                    own, begin = own[np.repeat(~odd[a:b], size[a:b])], np.concatenate([[0], np.cumsum(size[a:b][usual])])
                n[a + usual] = _counted(encoder, own, begin, chunk, overlap)
            for i in np.flatnonzero(n < 0).tolist():
                n[i] = count_huge(plain, texts[i].as_py(), chunk, overlap)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
