"""Removal of repeated byte strings over a whole corpus, with longest-previous-factor arrays.

A repeat is a string of `least` bytes that starts at two places. Each such window has an anchor: the piece of ANCHOR
bytes in it with the smallest hash (the last of equals). Equal windows have equal anchors, so windows can be compared
anchor by anchor, with nothing missed:

1. Each text gives its stretches: the run of windows that share an anchor, with the hash of all bytes they cover. Before
   anything is gathered, equal stretches are collapsed to their first copy.
2. Where an anchor has two or more different stretches, their bytes are fetched, brought together by anchor and sorted by
   suffix. The longest-previous-factor array, from the previous and next smaller positions in suffix order, shows which
   windows have an earlier match; its mirror, from the larger positions, which have a later one.
3. An anchor with more than `hot` different stretches is not gathered. Its stretches are cut by how far the anchor lies
   from the start of a window, and each part is keyed by the longer piece that all its windows share; equal windows still
   share a key. This is repeated with ever narrower parts, of one window in the end, and each round is steps 1 and 2 again.

Texts are shuffled twice, to fetch stretches and to be cut; all else that moves is hashes and stretches. All joins are
merge joins at every size, so a small corpus shows the cost of a large one, and Spark can split hot sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, fresh, settled, text_bytes, text_or_empty, written
from .hashing import ByteHashes, mix, sliding_min

ANCHOR = 32
SEGMENT = 1 << 20
GATHERED = 1 << 18  # bytes of stretches that are sorted at a time, and one group more
STRETCHES = "anchor long, stretch long, row long, doc long, first long, n int, at int"


def stretches(data: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """anchor hash, stretch hash, first window, count of windows and place of the anchor; `at`: offsets of the texts."""
    none = np.zeros(0, np.int64)
    if len(data) < least:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    hashes = ByteHashes(data)
    pieces = hashes.windows(ANCHOR)
    low = np.uint64((1 << 24) - 1)
    places = np.arange(len(pieces), dtype=np.uint64)
    best = sliding_min((pieces & ~low) | (low - places), least - ANCHOR + 1)
    anchor = (low - (best & low)).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, np.int64)  # windows that would cross the end of a text
    ends = at[1:]
    np.add.at(edge, np.clip(ends - least + 1, at[:-1], None).clip(0, len(anchor)), 1)
    np.add.at(edge, ends.clip(0, len(anchor)), -1)
    valid = np.cumsum(edge[:-1]) == 0
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (np.diff(anchor) != 0) | (valid[1:] != valid[:-1])
    fresh[at[:-1][at[:-1] < len(anchor)]] = True
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(anchor)))
    keep = valid[first]
    first, n = first[keep], n[keep]
    return pieces[anchor[first]], hashes.ranges(first, first + n - 1 + least), first, n, anchor[first]


def _segments(at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of bytes to work on: whole texts, and huge ones in overlapping parts; with the text of each."""
    row, start, stop = [], [], []
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        for s in range(a, max(b - least + 1, a + 1), SEGMENT):
            row.append(i)
            start.append(s)
            stop.append(min(b, s + SEGMENT + least - 1))
    return np.array(row, np.int64), np.array(start, np.int64), np.array(stop, np.int64)


def _find_stretches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, docs = batch.column(0), batch.column(1)
            data, at = text_bytes(batch.column(2))
            row, start, stop = _segments(at, least)
            for a, b in byte_groups(stop - start, SEGMENT // 2):
                sizes = stop[a:b] - start[a:b]
                part = np.concatenate([data[s:e] for s, e in zip(start[a:b].tolist(), stop[a:b].tolist(), strict=True)]) if b - a > 1 else data[start[a] : stop[a]]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                anchor, stretch, first, n, anchored = stretches(part, ends, least)
                seg = np.searchsorted(ends, first, "right") - 1
                own = row[a:b][seg]
                place = first - ends[seg] + start[a:b][seg] - at[own]
                own = pa.array(own)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), rows.take(own), docs.take(own), pa.array(place, pa.int64()), pa.array(n, pa.int32()), pa.array(anchored - first, pa.int32())], names=["anchor", "stretch", "row", "doc", "first", "n", "at"])

    return run


def suffix_order(data: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the suffixes at `starts` that can match another one, in suffix order, and their common prefixes.

    Symbols are pieces of an eighth of `least` bytes, ordered by hash, so suffixes sort by the symbols that follow each
    other in them. A suffix of which one symbol occurs nowhere else has no match and is left out. The common prefix with
    the suffix before is counted in whole symbols and reaches `least` where all bytes agree.
    """
    unit = max(1, least // 8)
    hashes = ByteHashes(data).windows(unit)
    order = np.argsort(hashes)
    fresh = np.concatenate([[True], np.diff(hashes[order].view(np.int64)) != 0])
    symbol = np.empty(len(hashes), np.int32)
    symbol[order] = np.cumsum(fresh) - 1
    common = np.bincount(symbol)[symbol] > 1
    steps = [*range(0, least - unit + 1, unit)]
    if steps[-1] != least - unit:
        steps.append(least - unit)
    alive = np.ones(len(starts), bool)
    for step in steps:
        alive &= common[starts + step]
    starts = starts[alive]
    symbols = [symbol[starts + step] for step in steps]
    by = np.lexsort((starts, *reversed(symbols)))
    lcp = np.zeros(len(by), np.int64)
    same = np.ones(max(0, len(by) - 1), bool)
    for step, column in zip(steps, symbols, strict=True):
        same &= np.diff(column[by]) == 0
        lcp[1:][same] = step + unit
    return starts[by], lcp


def _match_before(position: np.ndarray, link: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Match of each suffix with the nearest one before it in suffix order that has a smaller position; 0 if none.

    `link`: common prefix with the suffix before, `joined`: whether the two are in one interval; none is crossed. Minima
    over 1, 2, 4, ... suffixes let all suffixes step over the larger positions at once.
    """
    places = np.arange(len(position))
    head = np.maximum.accumulate(np.where(joined, 0, places))
    longest = int((places - head).max(initial=0))
    lowest, shared = [position], [link]
    while 1 << len(lowest) <= longest:
        half = 1 << len(lowest) - 1
        for table in (lowest, shared):
            wider = table[-1].copy()
            np.minimum(wider[half:], table[-1][:-half], out=wider[half:])
            table.append(wider)
    at, match = places - 1, link.copy()
    for k in reversed(range(len(lowest))):
        over = (at - (1 << k) + 1 >= head) & (lowest[k][at] > position)
        match[over] = np.minimum(match[over], shared[k][at[over]])
        at[over] -= 1 << k
    return np.where(at >= head, match, 0)


def longest_previous_factor(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Length of the longest match that starts earlier, for each suffix of the order; 0 where none reaches `least`.

    It is the better of the matches with the previous and the next smaller position in suffix order. Only neighbours
    that share `least` bytes can lie between, so each such interval is looked at on its own.
    """
    best = np.zeros(len(order), np.int32)
    linked = lcp >= least
    inside = linked.copy()
    inside[:-1] |= linked[1:]
    places = np.flatnonzero(inside)
    position, link, joined = order[places].astype(np.int32), lcp[places].astype(np.int32), linked[places]
    back = np.append(0, np.arange(len(places) - 1, 0, -1))[: len(places)]  # the link of a reversed suffix with the one before it
    after = _match_before(position[::-1], np.where(back, link[back], 0), joined[back] & (back > 0))[::-1]
    best[places] = np.maximum(_match_before(position, link, joined), after)
    return best


def longest_next_factor(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Length of the longest match that starts later: the mirror of `longest_previous_factor`."""
    return longest_previous_factor(-order, lcp, least)


def _windows_with_match(texts: list[bytes], n: np.ndarray, least: int, earlier: bool) -> list[np.ndarray]:
    """For each stretch, which of its windows match an earlier one, or, if not `earlier`, also a later one."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    order, lcp = suffix_order(data, np.repeat(at[:-1], n) + step, least)
    longest = longest_previous_factor(order, lcp, least)
    if not earlier:
        longest = np.maximum(longest, longest_next_factor(order, lcp, least))
    hit = np.zeros(len(data), bool)
    hit[order] = longest >= least
    return [hit[s : s + k] for s, k in zip(at[:-1].tolist(), n.tolist(), strict=True)]


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _match_stretches(least: int, earlier: bool):
    """Rows sorted by anchor, doc, row, first: (anchor, doc, row, first, n, alone, bytes) -> (row, first, n).

    Windows match only within an anchor, so the order of places matters only there.
    """

    def settle(held: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        if held:
            found = _windows_with_match([h[5] for h in held], np.array([h[3] for h in held]), least, earlier)
            for (_, row, first, _, alone, _), mask in zip(held, found, strict=True):
                if alone or earlier:
                    out += [(row, first + a, b - a) for a, b in _spans(mask)]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())], names=["row", "first", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        size = 0
        for batch in batches:
            anchor, _, row, first, n, alone, body = (c.to_pylist() for c in batch.columns)
            for x in zip(anchor, row, first, n, alone, body, strict=True):
                if group and group[0][0] != x[0]:
                    held += group
                    group = []
                    if size > GATHERED:
                        yield settle(held)
                        held, size = [], 0
                group.append(x)
                size += len(x[5])
        yield settle(held + group)

    return run


def _narrow(least: int, width: int):
    """(doc, row, first, n, at, body) of stretches -> their parts, of windows that start up to `width` bytes apart.

    The anchor lies `at` bytes after the first window. A part's key is the hash of what all windows of its cell share,
    the cell being how far before the anchor they start, in steps of `width`.
    """
    names = ["anchor", "stretch", "row", "doc", "first", "n", "at", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, row = batch.column(0), batch.column(1)
            first, n, at = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
            data, begin = text_bytes(batch.column(5))
            low, high = (at - n + 1) // width, at // width
            owner = np.repeat(np.arange(len(n)), high - low + 1)
            count = np.cumsum(high - low + 1) - (high - low + 1)
            cell = low[owner] + np.arange(len(owner)) - count[owner]
            head = np.maximum(0, at[owner] - (cell + 1) * width + 1)
            size = np.minimum(n[owner] - 1, at[owner] - cell * width) - head + 1
            hashes, base = ByteHashes(data), begin[:-1][owner]
            shared = base + at[owner] - cell * width
            key = mix(hashes.ranges(shared, shared + least - width + 1) + cell.astype(np.uint64))
            stretch = hashes.ranges(base + head, base + head + size - 1 + least)
            bodies = pa.array([data[a:b].tobytes() for a, b in zip((base + head).tolist(), (base + head + size - 1 + least).tolist(), strict=True)], pa.binary())
            own = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(stretch.view(np.int64)), row.take(own), doc.take(own), pa.array(first[owner] + head), pa.array(size.astype(np.int32)), pa.array((at[owner] - head).astype(np.int32)), bodies], names=names)

    return run


def _collapsed(seen: DataFrame, keep_first: bool, hot: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The runs that go because a whole stretch has a copy; and one of each different stretch of the anchors that have several."""
    place = F.struct("doc", "row", "first")
    kinds = seen.groupBy("anchor", "stretch").agg(F.count("*").alias("times"), F.min(place).alias("p"), F.first("n").alias("n"), F.first("at").alias("at"))
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    kinds = written(kinds.join(several, "anchor", "left").where("times > 1 or kinds is not null"), f"{name}-kinds")
    copies = kinds.where("times > 1").select("anchor", "stretch", "p")
    whole = seen.join(copies.hint("merge"), ["anchor", "stretch"])
    if keep_first:
        whole = whole.where(~place.eqNullSafe(F.col("p")))
    single = kinds.where("kinds is not null").select("anchor", "stretch", "p.doc", "p.row", "p.first", "n", "at", (F.col("times") == 1).alias("alone"), (F.col("kinds") > hot).alias("crowd"))
    return whole.select("row", "first", "n"), single


def repeated_windows(docs: DataFrame, *, least: int = 400, keep_first: bool, hot: int = 512) -> DataFrame:
    """(row, first, n): runs of n windows of `least` bytes, from byte `first` of the text, that must go.

    `docs`: row, doc, text. With `keep_first` those that start earlier too (by doc, row, place), else those that start
    anywhere else.
    """
    seen = written(docs.mapInArrow(_find_stretches(least), STRETCHES), "stretches")
    gone, single = _collapsed(seen, keep_first, hot, "anchors")
    body = F.substring(F.encode("text", "UTF-8"), F.col("first").cast("int") + 1, F.col("n") + least - 1)
    found = docs.select("row", "text").join(single.hint("merge"), "row").withColumn("body", body)
    width = least - ANCHOR + 1
    while True:
        bodies = written(found.select("anchor", "doc", "row", "first", "n", "alone", "at", "crowd", "body"), "bodies")
        calm = bodies.where("not crowd").select("anchor", "doc", "row", "first", "n", "alone", "body").repartition("anchor").sortWithinPartitions("anchor", "doc", "row", "first")
        gone = gone.unionByName(calm.mapInArrow(_match_stretches(least, keep_first), "row long, first long, n int"))
        crowd = bodies.where("crowd")
        if width == 1 or crowd.isEmpty():
            return gone
        width = -(-width // 8)
        parts = written(crowd.select("doc", "row", "first", "n", "at", "body").mapInArrow(_narrow(least, width), f"{STRETCHES}, body binary"), "parts")
        more, single = _collapsed(parts, keep_first, hot, "parts")
        gone = gone.unionByName(more)
        place = ["anchor", "stretch", "row", "first"]
        found = parts.select(*place, "body").join(single.hint("merge"), place)


def _cut(least: int, text_at: int, as_text: bool, added: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
            for a, b in byte_groups(size, SEGMENT):
                yield cut(batch.slice(a, b - a))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = pc.fill_null(batch.column(text_at).cast(pa.binary()), b"").to_pylist()
        kept, removed, spans = [], [], []
        for body, runs in zip(bodies, batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            gone: list[list[int]] = []
            for first, n in sorted((r["first"], r["n"]) for r in runs or ()):
                stop = first + n - 1 + least
                if gone and first <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], stop)
                else:
                    gone.append([first, stop])
            parts, at = [], 0
            for a, b in gone:
                parts.append(body[at:a])
                at = b
            left = b"".join([*parts, body[at:]]) if gone else body
            removed.append(len(body) - len(left))
            spans.append(len(gone))
            kept.append(left.decode("utf-8", "ignore") if as_text else left)
        names = batch.schema.names[:-1]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], names=[*names, *added])

    return run


def dedup(docs: DataFrame, *, least: int = 400, keep_first: bool = True, as_text: bool = False, added: tuple[str, str, str] = ("_kept", "_removed", "_spans"), hot: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with what is left of each text.

    Adds `_kept` (bytes; as text, without characters that a cut has split, if asked), `_removed` (how many bytes) and
    `_spans` (maximal removed runs), or what `added` calls them; input columns of these names go. A byte goes if a string of `least`
    bytes that covers it starts also at an earlier place (`keep_first`; order of id, row, place), or also anywhere else.
    Strings never cross texts. Null texts are empty; null ids come first; repeated rows are later copies of each other;
    an empty table stays empty. A `docs` that is no scan or checkpoint is written first, as it is read twice.
    """
    docs = settled(docs.drop(*added), "texts")
    row, spans = fresh(docs, "_row"), fresh(docs, "_gone")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    keyed = rows.select(F.col(row).alias("row"), F.col(id_column).cast("long").alias("doc"), text_or_empty(text_column).alias("text"))
    gone = repeated_windows(keyed, least=least, keep_first=keep_first, hot=hot).groupBy("row").agg(F.collect_list(F.struct("first", "n")).alias(spans))
    gone = written(gone.withColumnRenamed("row", row), "gone")
    joined = rows.join(gone.hint("merge"), row, "left").select(*docs.columns, spans)
    schema = docs.withColumns({added[0]: F.lit("" if as_text else b""), added[1]: F.lit(0).cast("long"), added[2]: F.lit(0).cast("long")}).schema
    return joined.mapInArrow(_cut(least, docs.columns.index(text_column), as_text, added), schema)


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    left = dedup(docs, keep_first=False)
    n_bytes = F.octet_length(text_or_empty("text")).cast("long")
    kept = F.make_valid_utf8(F.col("_kept").cast("string"))  # U+FFFD where a cut has split a character
    return left.select(F.col("doc_id").cast("long").alias("doc_id"), n_bytes.alias("n_bytes"), F.col("_removed").alias("n_removed"), F.col("_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"), kept.alias("text"))
