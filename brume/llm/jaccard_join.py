"""Near-duplicate join on word 5-grams with a MinHash LSH forest and exact verification.

Each text has a label of `depth` MinHash values in each of `trees` prefix tries, in which labels are sorted. In each trie a
text is first compared with those that share its whole label, and the matched prefix is then shortened, one value at a
time, until the text's target is met (`forest_links`): the chance that this trie misses a partner at `threshold` must
not be over the trees-th root of 1 - `recall`. Each partner that was found lowers it, as the missing one is near to that
one as well (triangle inequality of the Jaccard distance). So texts in dense places stop at long prefixes, others go on to
the length at which even a lonely pair meets often enough (`prefix_length`). This is done twice:

* every task sorts its own texts into stars: a leader and those whose signatures say they are as near as the
  threshold. Only leaders are shuffled, so a group of copies costs at most a few rows per task, however large it is;
* leaders that meet are linked while their signatures leave room for two near members, comparing only those that are not
  connected yet.

Links make candidate clusters (alternating large-star and small-star rounds). Each cluster's different texts are then
fetched, and all their pairs are verified on the exact shingle sets by counting shared shingles.

No task holds a whole node or cluster that is large: it is cut into blocks by a hash of the row, and every two blocks meet
in a group of their own, which bounds what a task holds. Two blocks of texts give each text's part of the links, and its
least row within reach; the classes are the components of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MOST_BROADCAST, byte_groups, fresh, is_space, settled, sized_broadcast, text_bytes, text_or_empty, word_starts, written
from .hashing import ByteHashes, mix

SKETCHES = "kind string, row long, doc long, text_hash binary, size long, tree int, prefix long, signature binary, members array<long>"
BLOCK_BYTES = 16 << 20  # of texts in one block of a cluster


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """Longest prefix at which a pair at the threshold still meets with the wanted probability: none is shortened below it."""
    for m in range(depth, 0, -1):
        if 1 - (1 - threshold**m) ** trees >= recall:
            return m
    raise ValueError("more trees are needed for this recall")


def shingle_hashes(data: np.ndarray, at: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of `words` words, and n + 1 offsets. A shorter text is one shingle of all its words."""
    space = is_space(data)
    starts = np.flatnonzero(word_starts(data, at, space))
    last = ~space
    last[:-1] &= space[1:]
    last[at[1:][at[1:] > at[:-1]] - 1] = ~space[at[1:][at[1:] > at[:-1]] - 1]
    stops = np.flatnonzero(last) + 1
    hashed = ByteHashes(data).ranges(starts, stops)
    first = np.searchsorted(starts, at)
    n_words = np.diff(first)
    n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(n)), n)
    place = first[owner] + np.arange(offsets[-1]) - offsets[owner]
    total = np.zeros(len(place), np.uint64)
    for k in range(words):
        there = place + k < first[owner + 1]
        total = np.where(there, mix(total + hashed[np.minimum(place + k, len(hashed) - 1)] + np.uint64(k)) if len(hashed) else total, total)
    return total, offsets


def signatures(shingles: np.ndarray, offsets: np.ndarray, functions: int) -> np.ndarray:
    """MinHash values (texts x functions) of the texts that have shingles."""
    has = np.flatnonzero(np.diff(offsets))
    out = np.empty((len(has), functions), np.uint32)
    if len(has):
        for j in range(functions):
            a = mix(np.array([j + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0] | np.uint64(1)
            out[:, j] = np.minimum.reduceat((shingles * a) >> np.uint64(32), offsets[has])
    return out


def _estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity from the low bytes of MinHash values."""
    same = (many == one).mean(axis=1)
    return (same - 1 / 256) / (1 - 1 / 256)


def forest_links(labels: np.ndarray, low: np.ndarray, *, enough: float, threshold: float, missed: float, shortest: int, stars: bool) -> list[tuple[int, int]]:
    """Pairs of texts of one node of a trie whose signatures agree by `enough`, at adaptively shortened prefixes.

    `labels` (texts x depth): the trie's labels, `low`: low bytes of the signatures, `missed`: the chance that this trie may
    miss a partner at `threshold`. Connected texts are not compared again; with `stars`, pairs are (leader, member), and
    a member has one leader and no members. No prefix is shortened below `shortest`.
    """
    n, depth = labels.shape
    order = np.lexsort(labels.T[::-1])
    common = np.cumprod(labels[order][1:] == labels[order][:-1], axis=1).sum(axis=1)  # with the label before, in the trie's order
    lengths = np.arange(depth + 1)
    chance = np.tile(np.log1p(-(threshold ** np.maximum(lengths, 1))), (n, 1))  # log of what is missed at each prefix length
    group, member = np.arange(n), np.zeros(n, bool)
    pairs: list[tuple[int, int]] = []
    for length in range(depth, shortest - 1, -1):
        heads = np.flatnonzero(np.append(True, common < length))
        sizes = np.diff(np.append(heads, n))
        for s, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            node = order[s : s + size]
            for i in (node if length == depth else node[chance[node, length + 1] > np.log(missed)]).tolist():
                if stars and member[i]:
                    continue
                others = node[group[node] == node] if stars else node[group[node] != group[i]]
                if stars:
                    others = others[(others != i) & ~np.isin(others, group[member])]
                if not len(others):
                    if not stars:
                        break  # the node is connected
                    continue
                alike = _estimates(low[i], low[others])
                close = others[alike >= enough]
                if len(close):
                    pairs += [(i, j) for j in close.tolist()]
                    near = np.log1p(-(np.clip(alike[alike >= enough] + threshold - 1, 0, 0.999)[:, None] ** np.maximum(lengths, 1)))
                    chance[i] += near.sum(axis=0)
                    chance[close] += near
                    if stars:
                        group[close], member[close] = i, True
                    else:
                        group[np.isin(group, group[close])] = group[i]
    return pairs


def _sketch(trees: int, depth: int, prefix: int, near: float, missed: float):
    names = ["kind", "row", "doc", "text_hash", "size", "tree", "prefix", "signature", "members"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            n = batch.num_rows
            data, at = text_bytes(batch.column(2))
            held = memoryview(data)
            digests = [xxhash.xxh3_128_digest(held[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            for a, b in byte_groups(np.diff(at), 1 << 20):
                shingles, offsets = shingle_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a])
                labels.append(signatures(shingles, offsets, trees * depth))
                rows.append(batch.column(0).to_numpy()[a:b][np.diff(offsets) > 0])
            yield pa.RecordBatch.from_arrays([pa.array(["doc"] * n), batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(np.diff(at), pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64()))], names=names)
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        label = np.concatenate(labels) if labels else np.zeros((0, trees * depth), np.uint32)
        low = (label & np.uint32(255)).astype(np.uint8)
        for tree in range(trees):
            own = slice(tree * depth, (tree + 1) * depth)
            key = np.zeros(len(row), np.uint64)
            for k in range(prefix):
                key = mix(key + label[:, tree * depth + k] + np.uint64(tree * depth + k + 1))
            order = np.argsort(key, kind="stable")
            heads = np.flatnonzero(np.concatenate([[True], np.diff(key[order].view(np.int64)) != 0])) if len(order) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(heads, len(order)))
            members: dict[int, list[int]] = {i: [] for i in order.tolist()}
            for s, n in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                node = order[s : s + n]
                for i, j in forest_links(label[node, own], low[node], enough=near, threshold=near, missed=missed, shortest=prefix, stars=True):
                    members[int(node[i])].append(int(row[node[j]]))
                    del members[int(node[j])]
            leaders, n = list(members), len(members)
            _, node, here = np.unique(key[leaders], return_inverse=True, return_counts=True)  # this task's leaders in the node
            yield pa.RecordBatch.from_arrays([pa.array(["leader"] * n), pa.array(row[leaders], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(here[node], pa.int64()), pa.array(np.full(n, tree, np.int32)), pa.array(key[leaders].view(np.int64)), pa.array([low[i].tobytes() for i in leaders], pa.binary()), pa.array(list(members.values()), pa.list_(pa.int64()))], names=names)

    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows sorted by the first `keys` columns, in tables that never split a group."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_numpy() for k in range(keys)]
        change = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in enumerate(columns)):
            yield pa.concat_tables(held)
            held = []
        if len(change):
            yield pa.concat_tables([*held, table.slice(0, change[-1])])
            held = [table.slice(change[-1])]
        else:
            held.append(table)
    if held:
        yield pa.concat_tables(held)


def _met(df: DataFrame, blocks: Column, itself: bool) -> DataFrame:
    """`df` with block, one and two: a row once for each two blocks of its group of which it is in one.

    `blocks`: how many blocks the row's group has. `itself`: each block also meets itself.
    """
    block = F.pmod(F.xxhash64("row"), blocks).cast("int")
    others = F.sequence(F.lit(0), (blocks - 1).cast("int"))
    if not itself:
        others = F.filter(others, lambda x: (x != F.col("block")) | (blocks == 1))
    pairs = F.transform(others, lambda x: F.struct(F.least("block", x).alias("one"), F.greatest("block", x).alias("two")))
    return df.withColumn("block", block).withColumn("_met", F.explode(pairs)).withColumns({"one": F.col("_met.one"), "two": F.col("_met.two")}).drop("_met")


def _link_leaders(depth: int, prefix: int, threshold: float, room: float, missed: float):
    """Links (a, b) between leaders in one trie node, or in two blocks of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 4):
            keys, row = [table.column(k).to_numpy() for k in range(4)], table.column(4).to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], np.any([np.diff(k) != 0 for k in keys], axis=0)]))
            sizes = np.diff(np.append(heads, len(row)))
            signature = table.column(5)
            one, two = [], []
            for s, n in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                low = np.frombuffer(b"".join(signature.slice(s, n).to_pylist()), np.uint8).reshape(n, -1)
                label = low[:, keys[0][s] * depth : (keys[0][s] + 1) * depth]  # low bytes: two that differ seem alike once in 256 times, which only adds a comparison
                for i, j in forest_links(label, low, enough=room, threshold=threshold, missed=missed, shortest=prefix, stars=False):
                    one.append(int(row[s + i]))
                    two.append(int(row[s + j]))
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of each connected component. `edges`: a, b (long).

    Alternating large-star and small-star rounds; each round is written to the shared folder, and only a count and a
    checksum come back.
    """

    def tidy(e: DataFrame) -> DataFrame:
        return e.where("a <> b").distinct()

    def star(e: DataFrame, large: bool) -> DataFrame:
        wide = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        if large:
            return tidy(wide.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")))
        return tidy(wide.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))))

    now, before = written(tidy(edges), "edges"), None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or not state["n"]:
            break
        before = state
        now = written(star(star(now, True), False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def linked_pairs(sets: list[np.ndarray], others: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of `others` reach the Jaccard similarity with which of `sets` (sets x others); all are of distinct hashes."""
    sizes = np.array([len(s) for s in others])
    values, code = np.unique(np.concatenate(others), return_inverse=True)
    posts = np.repeat(np.arange(len(others)), sizes)[np.argsort(code, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(values)))])
    found = np.zeros((len(sets), len(others)), bool)
    for i, own in enumerate(sets):
        at = np.searchsorted(values, own)
        there = at < len(values)
        there[there] = values[at[there]] == own[there]
        at = at[there]
        lengths = begin[at + 1] - begin[at]
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        shared = np.bincount(posts[np.repeat(begin[at], lengths) + step], minlength=len(others))
        found[i] = (shared > 0) & (shared >= threshold * (len(own) + sizes - shared))
    return found


def least_reached(found: np.ndarray, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least row in the connected component of each row on either side of the links `found`."""
    one, two = np.full(len(rows), -1), np.full(len(others), -1)
    for side, i in [(0, k) for k in range(len(rows))] + [(1, k) for k in range(len(others))]:
        if (one, two)[side][i] >= 0:
            continue
        parts, queue, seen = ([], []), [(side, i)], (one, two)
        seen[side][i] = 0
        while queue:
            at, k = queue.pop()
            parts[at].append(k)
            new = np.flatnonzero((found[k] if at == 0 else found[:, k]) & (seen[1 - at] < 0))
            seen[1 - at][new] = 0
            queue += [(1 - at, n) for n in new.tolist()]
        least = min(np.min(v[p]) for v, p in ((rows, parts[0]), (others, parts[1])) if p)
        one[parts[0]] = two[parts[1]] = least
    return one, two


VERIFIED = "text_hash binary, row long, root long, n_links long, whole boolean"


def _verify(threshold: float, words: int):
    """(cluster, one, two, block, blocks, row, text_hash, text) by two blocks of a cluster -> VERIFIED."""

    def settle(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        data, at = text_bytes(group.column(7))
        sets: list[np.ndarray] = []
        for a, b in byte_groups(np.diff(at), 1 << 20):
            shingles, offsets = shingle_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a], words)
            sets += [np.unique(shingles[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        row, block = group.column(5).to_numpy(), group.column(3).to_numpy()
        first = np.flatnonzero(block == group.column(1)[0].as_py())
        second = np.flatnonzero(block != group.column(1)[0].as_py())
        root, n = row.copy(), np.zeros(len(row), np.int64)
        if group.column(1)[0] == group.column(2)[0]:
            found = linked_pairs(sets, sets, threshold)
            np.fill_diagonal(found, False)
            n[:] = found.sum(axis=1)
            np.fill_diagonal(found, True)
            root, _ = least_reached(found, row, row)
        elif len(first) and len(second):
            found = linked_pairs([sets[i] for i in first], [sets[i] for i in second], threshold)
            n[first], n[second] = found.sum(axis=1), found.sum(axis=0)
            root[first], root[second] = least_reached(found, row[first], row[second])
        return root, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            change = np.any([np.diff(table.column(k).to_numpy()) != 0 for k in range(3)], axis=0)
            heads = np.append(np.flatnonzero(np.concatenate([[True], change])), table.num_rows).tolist()
            found = [settle(table.slice(a, b - a)) for a, b in zip(heads[:-1], heads[1:], strict=True)]
            root, n = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([table.column(6).combine_chunks(), table.column(5).combine_chunks(), pa.array(root), pa.array(n), pa.array(table.column(4).to_numpy() == 1)], names=["text_hash", "row", "root", "n_links", "whole"])

    return run


def near_duplicates(
    docs: DataFrame, *, threshold: float = 0.8, words: int = 5, trees: int = 12, depth: int = 6, recall: float = 0.999, block_texts: int = 2048, block_leaders: int = 8192, max_broadcast: int = MOST_BROADCAST,
    id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: row, doc_id, class_id, n_links, n_copies, is_first.

    A class holds the texts that links of similarity `threshold` or more connect, equal texts included; class_id is its
    least doc_id. n_links: different texts that this text is linked to; n_copies: rows with exactly this text.
    is_first marks one row of each class: the least doc_id, then the least row. A text of fewer words is one shingle;
    texts without words, null ones too, are alike only if equal (null as empty). Null ids come last in a class; other
    columns are ignored; an empty table gives no rows. A `docs` that is no scan or checkpoint is written first, as it is read
    twice. Clusters of over `block_texts` different texts or BLOCK_BYTES, and trie
    nodes of over `block_leaders` leaders, are worked on two blocks at a time.
    """
    docs = settled(docs, "texts")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc"), text_or_empty(text_column).alias("text"))
    prefix = prefix_length(threshold, trees, depth, recall)
    missed = (1 - recall) ** (1 / trees)
    sketches = written(rows.mapInArrow(_sketch(trees, depth, prefix, threshold, missed), SKETCHES), "sketches")
    every = sketches.where("kind = 'doc'").select("row", "doc", "text_hash", F.col("size").alias("n_bytes"))
    leaders = sketches.where("kind = 'leader'")
    room = max(0.05, 1 - 3 * (1 - threshold) - 0.15)  # three distances, and what signatures may err
    nodes = leaders.select("tree", "prefix", F.lit(0).alias("one"), F.lit(0).alias("two"), "row", "signature")
    tasks = (every.agg(F.max(F.shiftright("row", 33))).first()[0] or 0) + 1
    many = leaders.where(F.col("size") * tasks > block_leaders).select("tree", "prefix").distinct()  # no other node can have so many
    if not many.isEmpty():
        crowds = leaders.join(many, ["tree", "prefix"], "left_semi").groupBy("tree", "prefix").agg(F.count("*").alias("n"))
        crowded = nodes.drop("one", "two").join(sized_broadcast(written(crowds, "crowds"), max_broadcast), ["tree", "prefix"], "left")
        nodes = _met(crowded, F.ceil(F.coalesce("n", F.lit(1)) / block_leaders), False).select(*nodes.columns)
    nodes = nodes.repartition("tree", "prefix", "one", "two").sortWithinPartitions("tree", "prefix", "one", "two")
    edges = nodes.mapInArrow(_link_leaders(depth, prefix, threshold, room, missed), "a long, b long").union(leaders.select(F.col("row").alias("a"), F.explode("members").alias("b")))
    clusters = components(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))

    texts = every.join(clusters, every["row"] == clusters["node"]).groupBy("root", "text_hash").agg(F.min("row").alias("row"), F.first("n_bytes").alias("n_bytes"))
    blocks = F.ceil(F.greatest(F.count("*") / block_texts, F.sum("n_bytes") / BLOCK_BYTES)).cast("int")
    several = texts.groupBy("root").agg(F.count("*").alias("n"), F.greatest(blocks, F.lit(1)).alias("blocks")).where("n > 1")
    texts = written(texts.join(several, "root").select(F.col("root").alias("cluster"), "text_hash", "row", "blocks"), "texts")
    n_split = texts.where("blocks > 1").count()
    bodies = _met(rows.select("row", "text").join(sized_broadcast(texts, max_broadcast), "row"), F.col("blocks"), True).select("cluster", "one", "two", "block", "blocks", "row", "text_hash", "text")
    bodies = bodies.repartition("cluster", "one", "two").sortWithinPartitions("cluster", "one", "two", "text_hash")
    verified = written(bodies.mapInArrow(_verify(threshold, words), VERIFIED), "verified")
    if n_split:
        split = verified.where("not whole")
        joined = components(split.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b"))).withColumnRenamed("root", "least")
        links = split.groupBy("text_hash", "row").agg(F.sum("n_links").alias("n_links"))
        links = links.join(joined, links["row"] == joined["node"], "left").select("text_hash", "row", F.coalesce("least", "row").alias("root"), "n_links", F.lit(False).alias("whole"))
        verified = verified.where("whole").unionByName(links)
    verified = verified.select("text_hash", F.unhex(F.lpad(F.hex("root"), 16, "0")).alias("class_hash"), "n_links")  # 8 bytes, so unlike any text's hash

    copies = every.groupBy("text_hash").agg(F.count("*").alias("n_copies"), F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("least"))
    classed = copies.join(verified, "text_hash", "left").select("text_hash", "n_copies", "least", F.coalesce("class_hash", "text_hash").alias("class_hash"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    firsts = classed.groupBy("class_hash").agg(F.min("least").alias("top"))
    known = classed.join(firsts, "class_hash").select("text_hash", "n_links", "n_copies", "top")
    return every.join(known, "text_hash").select("row", F.col("doc").alias("doc_id"), F.col("top.doc").alias("class_id"), "n_links", "n_copies", (F.col("row") == F.col("top.row")).alias("is_first"))


def keep_firsts(docs: DataFrame, *, max_broadcast: int = MOST_BROADCAST, **options) -> DataFrame:
    """One row of each near-duplicate class (`is_first` of `near_duplicates`), with all columns of `docs`."""
    docs = settled(docs, "texts")
    later = written(near_duplicates(docs, max_broadcast=max_broadcast, **options).where("not is_first").select("row"), "later")
    row = fresh(docs, "_row")
    later = sized_broadcast(later.withColumnRenamed("row", row), max_broadcast)
    return docs.withColumn(row, F.monotonically_increasing_id()).join(later, row, "left_anti").select(*docs.columns)


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "n_links", "n_copies")
