"""Fill-in-middle texts, cut at line ends that a learned rank index finds.

The boundaries of a text (0 and the end of each line, in bytes) are a rising sequence: rank to offset. It is covered from
left to right by straight pieces, each as long as some line through its first point keeps within `error` bytes of all
its points (the cone of slopes that are left has not closed). The index of a text is its pieces (first rank, first
offset, slope) and for each boundary what the rounded prediction lacks, in one, two or four bytes. A cut is predicted by its piece and
set right by the stored residual, so it is exact whatever the pieces are. The index is built from the whole text and
depends on nothing else: a text may be cut again at other ranks without looking for its lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, fresh, text_bytes, text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ERROR = 512
GROUP = 1 << 22
INDEX_SCHEMA = "doc_id long, n long, first_ranks array<long>, first_offsets array<long>, slopes array<double>, width int, residuals binary"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass
class RankIndex:
    """Pieces and residuals of many sequences; `at` has where each sequence's points begin among all (one more than there are)."""

    at: np.ndarray
    first: np.ndarray  # of each piece, the place of its first point among all
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def _predict(self, points: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.first, points, "right") - 1
        return self.offset[piece] + np.rint(self.slope[piece] * (points - self.first[piece])).astype(np.int64)

    def lookup(self, sequence: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Exact offsets of these ranks of these sequences."""
        points = self.at[sequence] + rank
        return self._predict(points) + self.residual[points]


def fit(at: np.ndarray, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Pieces for sequences that each have a point at least, by cones of slopes: all sequences move on side by side.

    Each step looks at the next points of every piece that is still open, as many as keep the step's work even.
    """
    start, stop = at[:-1].copy(), at[1:]
    here = start + 1  # the next point to look at
    low, high = np.full(len(start), -np.inf), np.full(len(start), np.inf)
    first, slope = [], []
    live = np.arange(len(start))
    while len(live):
        width = max(16, min(4096, (1 << 16) // len(live)))
        s, h = start[live], here[live]
        points = h[:, None] + np.arange(width)
        there = points < stop[live][:, None]
        points = np.where(there, points, h[:, None] - 1)  # a point that is known, for which any slope will do
        run, rise = points - s[:, None], offsets[points] - offsets[s][:, None]
        run = np.maximum(run, 1)
        lows = np.maximum.accumulate(np.maximum(np.where(there, (rise - error) / run, -np.inf), low[live][:, None]), axis=1)
        highs = np.minimum.accumulate(np.minimum(np.where(there, (rise + error) / run, np.inf), high[live][:, None]), axis=1)
        fits = (lows <= highs) & there
        good = np.where(fits.all(axis=1), width, fits.argmin(axis=1))  # points that the piece still takes
        here[live] = h + good
        took = good > 0
        last = np.maximum(good - 1, 0)
        rows = np.arange(len(live))
        low[live] = np.where(took, lows[rows, last], low[live])
        high[live] = np.where(took, highs[rows, last], high[live])
        closed = live[good < width]
        first.append(start[closed])
        ends = np.isinf(low[closed])
        slope.append(np.where(ends, 0.0, (np.where(ends, 0, low[closed]) + np.where(ends, 0, high[closed])) / 2))
        start[closed] = here[closed]
        here[closed] += 1
        low[closed], high[closed] = -np.inf, np.inf
        live = live[start[live] < stop[live]]
    first, slope = np.concatenate(first or [np.zeros(0, np.int64)]), np.concatenate(slope or [np.zeros(0)])
    order = np.argsort(first)
    index = RankIndex(at, first[order], offsets[first[order]], slope[order], np.zeros(0, np.int64))
    index.residual = offsets - index._predict(np.arange(len(offsets)))
    return index


def boundaries(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's boundaries begin (n + 1), and all boundaries, from 0 in each text."""
    feeds = np.flatnonzero(data == 10) + 1
    owner = np.searchsorted(at, feeds - 1, "right") - 1
    full = np.diff(at) > 0
    open_end = np.flatnonzero(full & (data[np.maximum(at[1:] - 1, 0)] != 10)) if len(data) else np.zeros(0, np.int64)
    who = np.concatenate([np.arange(len(at) - 1), owner, open_end])
    where = np.concatenate([np.zeros(len(at) - 1, np.int64), feeds - at[owner], (at[1:] - at[:-1])[open_end]])
    order = np.lexsort((where, who))
    return np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(at) - 1))]), where[order]


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of an id: the first digits of a SHA-256."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def restore(output: bytes, form: str) -> bytes:
    """The text that an output of this form was made from. No text with a mark in it is cut, and a mark cannot begin within another."""
    if form == "plain":
        return output
    second, third = (SUFFIX, MIDDLE) if form == "psm" else (PREFIX, MIDDLE)
    a = output.index(second, len(PREFIX))
    b = output.index(third, a + len(second))
    one, two, middle = output[len(PREFIX) : a], output[a + len(second) : b], output[b + len(third) :]
    return one + middle + two if form == "psm" else two + middle + one


def _cut(data: np.ndarray, at: np.ndarray, ids: list, seed: int, cut_percent: int, spm_percent: int) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
    """For each text its number of lines, form, code points of prefix and middle, and output."""
    first, offsets = boundaries(data, at)
    index = fit(first, offsets)
    n = np.diff(first) - 1
    drawn = [draws(i, seed) for i in ids]
    one, two = (np.fromiter((d[k] for d in drawn), np.int64, len(ids)) % (n + 1) for k in (0, 1))
    every = np.arange(len(ids))
    a, b = index.lookup(every, np.minimum(one, two)), index.lookup(every, np.maximum(one, two))
    heads = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
    before, between = heads[at[:-1] + a] - heads[at[:-1]], heads[at[:-1] + b] - heads[at[:-1] + a]
    held = data.tobytes()
    for i, (lines, x, y, p, m) in enumerate(zip(n.tolist(), a.tolist(), b.tolist(), before.tolist(), between.tolist(), strict=True)):
        text = held[at[i] : at[i + 1]]
        if not text or drawn[i][2] % 100 >= cut_percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
            yield lines, "plain", None, None, text
        elif drawn[i][3] % 100 < spm_percent:
            yield lines, "spm", p, m, b"".join([SUFFIX, text[y:], PREFIX, text[:x], MIDDLE, text[x:y]])
        else:
            yield lines, "psm", p, m, b"".join([PREFIX, text[:x], SUFFIX, text[y:], MIDDLE, text[x:y]])


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, at = text_bytes(batch.column(column))
    for a, b in byte_groups(np.diff(at), GROUP):
        yield a, b, data[at[a] : at[b]], at[a : b + 1] - at[a]


def rank_index(docs: DataFrame, *, error: int = ERROR, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The index of every text: see INDEX_SCHEMA. `residuals` are little-endian signed numbers of `width` bytes, one for each of the n + 1 boundaries.

    Null and empty texts have one boundary and no line; null ids and repeated rows are kept; other columns are ignored;
    an empty table gives no rows. A text may be as long as a row can be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in _groups(batch, 1):
                first, offsets = boundaries(data, at)
                index = fit(first, offsets, error)
                pieces = np.searchsorted(index.first, first)
                rows = []
                for i in range(b - a):
                    p, r = slice(pieces[i], pieces[i + 1]), index.residual[first[i] : first[i + 1]]
                    most = int(np.abs(r).max())
                    width = 1 if most < 128 else 2 if most < 32768 else 4
                    rows.append((len(r) - 1, index.first[p] - first[i], index.offset[p], index.slope[p], width, r.astype(f"<i{width}").tobytes()))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.int32(), pa.binary()]
                names = ["n", "first_ranks", "first_offsets", "slopes", "width", "residuals"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(run, INDEX_SCHEMA)


def fill_in_middle(docs: DataFrame, *, seed: int = 7, cut_percent: int = 100, spm_percent: int = 50, digest: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every text cut in prefix, middle and suffix at two line ends drawn from its id: see SCHEMA.

    Lines are `[^\\n]*\\n|[^\\n]+`. `cut_percent` of the texts are cut, `spm_percent` of these suffix first; a text that is
    empty or holds one of the three marks stays `plain`, with null counts. With `digest` the columns output_sha256
    and restored_sha256 (of the text rebuilt from output and form) stand in place of `output`. Null texts are empty; a
    null id draws as an empty number; repeated rows are cut alike; other columns are ignored; an empty table gives no rows.
    """
    names = ["output_sha256", "restored_sha256"] if digest else ["output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in _groups(batch, 1):
                ids = batch.column(0).slice(a, b - a)
                n, form, p, m, out = zip(*_cut(data, at, ids.to_pylist(), seed, cut_percent, spm_percent), strict=True)
                if digest:
                    last = [pa.array([hashlib.sha256(x).hexdigest() for x in out]), pa.array([hashlib.sha256(restore(x, f)).hexdigest() for x, f in zip(out, form, strict=True)])]
                else:
                    last = [pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(form), pa.array(p, pa.int64()), pa.array(m, pa.int64()), *last], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *names])

    schema = SCHEMA.removesuffix("output string") + ", ".join(f"{x} string" for x in names)
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(run, schema)


def restored(outputs: DataFrame, *, output_column: str = "output", form_column: str = "form") -> DataFrame:
    """The rows of `outputs` with the texts they were made from, in `restored` (longer if there is such a column). Null outputs stay null."""
    name = fresh(outputs, "restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, form = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (output_column, form_column))
            texts = [None if x is None else restore(x.encode(), f or "plain").decode() for x, f in zip(out, form, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

    return outputs.mapInArrow(run, outputs.select("*", F.lit("").alias(name)).schema)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    return fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce("text", '') AS x, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(x, '[^\n]*\n|[^\n]+') AS l, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b FROM u),
p AS (SELECT doc_id, x, n, coalesce(array_to_string(l[1:a], ''), '') AS pre, coalesce(array_to_string(l[a + 1:b], ''), '') AS mid, coalesce(array_to_string(l[b + 1:], ''), '') AS suf,
  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN x ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
