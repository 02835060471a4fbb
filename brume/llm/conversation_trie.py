"""The prefix trie of conversations, its subtree totals by parallel tree contraction.

Turns are put in one order over all partitions, so a conversation may be longer than a task: places within it come from
counts by (conversation, partition). A prefix is named by its depth and six sums, over its turns, of 32-bit words of a SHA-256 of
place, role and text. Sums add up over partitions, and a node's parent is the node whose sums lack the last turn's words, so
no conversation is gathered and no turn is joined with the one before.

Contraction: in each round leaves are raked (their totals are final and go to their parents), then of every unary chain
nodes that drew heads above a child that drew tails are compressed: the child hangs on the grandparent and its edge carries
what the node had. Rounds grow with the logarithm of the nodes, not with depth. Re-expansion follows each compressed node to
the child it was pushed into, doubling the way in each round, and ends at a raked node. Every round is one aggregation by
parent, which combines before its shuffle, and joins on keys that are unique on both sides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

WORDS = r"[^\x20\x09-\x0D]+"
SUMS = [f"s{i}" for i in range(6)]
BLOCK = 1 << 16
SHARED = 20


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat_ws(":", depth.cast("string"), *(s.cast("string") for s in sums)), 256))


def _numbered(conversations: DataFrame) -> DataFrame:
    """Turns with their part (of one order of all) and place within conversation and part. Written once."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_at"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.sha2(F.concat_ws("\x00", "role", "text"), 256), F.col("_at")]
    dealt = turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), F.sha2(F.concat_ws("\x00", "role", "text"), 256), "_at"))
    return written(dealt.withColumn("local", local.cast("long")).select("conv_id", "part", "local", "role", "text"), "turns")


def shared_starts(conversations: DataFrame, *, shared: int = SHARED) -> DataFrame:
    """Conversations rebuilt with the first turns of every `shared`th one: (conv_id, part, place, role, text).

    Conversation c begins with the first crc32(c) % 4 turns of c - c % shared, then come its own after so many.
    `place` counts from 1; parts keep the order of places. Turns that tie are ordered by role and text.
    """
    turns = _numbered(conversations)
    by_conv = Window.partitionBy("conv_id")
    counts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    counts = counts.withColumns({"before": F.sum("n").over(by_conv.orderBy("part")) - F.col("n"), "size": F.sum("n").over(by_conv)})
    counts = written(counts, "counts")
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    convs = counts.groupBy("conv_id").agg(F.max("size").alias("size")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % shared})
    sizes = convs.select(F.col("conv_id").alias("base"), F.least("size", F.lit(3)).alias("there"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    own = turns.join(counts.join(convs.select("conv_id", "h", "taken"), "conv_id"), ["conv_id", "part"]).withColumn("rank", F.col("before") + F.col("local"))
    own = own.where("rank > h").select("conv_id", "part", (F.col("rank") - F.col("h") + F.col("taken")).alias("place"), "role", "text")
    firsts = turns.where((F.col("conv_id") % shared == 0) & (F.col("local") <= 3)).join(counts.select("conv_id", "part", "before"), ["conv_id", "part"])
    firsts = firsts.select(F.col("conv_id").alias("base"), (F.col("before") + F.col("local")).alias("place"), "role", "text").where("place <= 3")
    taken = convs.select("conv_id", "base", "taken").join(firsts, "base").where("place <= taken")
    return own.unionByName(taken.select("conv_id", F.lit(-1).alias("part"), "place", "role", "text"))


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """Each rebuilt turn with the node it ends, that node's parent and its words."""
    digest = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rebuilt.select("conv_id", "part", "place", F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"), digest.alias("digest"))
    rows = rows.withColumns({f"w{i}": F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(6)}).drop("digest")
    rows = written(rows, "words")
    within = Window.partitionBy("conv_id", "part").orderBy("place")
    parts = rows.groupBy("conv_id", "part").agg(*(F.sum(f"w{i}").alias(f"t{i}") for i in range(6)))
    over = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.select("conv_id", "part", *((F.sum(f"t{i}").over(over) - F.col(f"t{i}")).alias(f"t{i}") for i in range(6)))
    rows = rows.withColumns({f"s{i}": F.sum(f"w{i}").over(within) for i in range(6)}).join(parts, ["conv_id", "part"])
    full = [F.col(f"s{i}") + F.col(f"t{i}") for i in range(6)]
    last = [F.col(f"s{i}") + F.col(f"t{i}") - F.col(f"w{i}") for i in range(6)]
    return rows.select("conv_id", F.col("place").alias("depth"), "words", _node(F.col("place"), full).alias("id"), _node(F.col("place") - 1, last).alias("parent"))


def _heads(node: Column, turn: int) -> Column:
    return F.xxhash64(node, F.lit(turn)).bitwiseAND(1) == 1


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of `values` over each node's subtree: (id, values). `nodes`: id, parent (null for roots), values; a written table.

    A node whose parent is not among the nodes, or that is on a cycle, is an error of the input.
    """
    parents = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct().withColumn("inner", F.lit(True))
    live = nodes.join(parents, "id", "left").select("id", "parent", F.col("inner").isNull().alias("leaf"), *values, *(F.lit(0).cast("long").alias(f"edge_{v}") for v in values))
    live = written(live, "live")
    raked, pushed, turn = [], [], 0
    while True:
        raked.append(live.where("leaf").select("id", *values))
        sums = [F.sum(F.when(F.col("leaf"), F.col(v) + F.col(f"edge_{v}")).otherwise(0)).alias(f"add_{v}") for v in values]
        edges = [F.sum(F.when(~F.col("leaf"), F.col(f"edge_{v}")).otherwise(0)).alias(f"down_{v}") for v in values]
        below = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count_if(~F.col("leaf")).alias("n"), F.min(F.when(~F.col("leaf"), F.col("id"))).alias("child"), *sums, *edges)
        kept = live.where("NOT leaf").join(below, "id")
        compress = (F.col("n") == 1) & F.col("parent").isNotNull() & _heads(F.col("id"), turn) & ~_heads(F.col("child"), turn)
        kept = kept.select(
            "id", "parent", "child", (F.col("n") == 0).alias("leaf"), compress.alias("compress"),
            *((F.col(v) + F.col(f"add_{v}")).alias(v) for v in values), *(f"edge_{v}" for v in values), *(f"down_{v}" for v in values),
        )
        kept = written(kept, f"round-{turn}")
        if kept.isEmpty():
            break
        gone = kept.where("compress")
        pushed.append(gone.select("id", "child", *((F.col(v) + F.col(f"down_{v}")).alias(v) for v in values)))
        moved = gone.select(F.col("child").alias("id"), F.col("parent").alias("above"), *((F.col(v) + F.col(f"edge_{v}")).alias(f"more_{v}") for v in values))
        live = kept.where("NOT compress").join(moved, "id", "left").select(
            "id", F.coalesce("above", "parent").alias("parent"), "leaf", *values, *((F.col(f"edge_{v}") + F.coalesce(f"more_{v}", F.lit(0))).alias(f"edge_{v}") for v in values)
        )
        live, turn = written(live, f"live-{turn}"), turn + 1
    ends = reduce(DataFrame.unionByName, raked)
    if not pushed:
        return ends
    open_ = reduce(DataFrame.unionByName, pushed)
    for _ in range(len(pushed).bit_length()):  # each way goes on to later rounds only, so it has at most one step a round
        on = open_.select(F.col("id").alias("child"), F.col("child").alias("next"), *(F.col(v).alias(f"more_{v}") for v in values))
        open_ = open_.join(on, "child", "left").select("id", F.coalesce("next", "child").alias("child"), *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values))
        open_ = written(open_, "ways")
    final = ends.select(F.col("id").alias("child"), *(F.col(v).alias(f"more_{v}") for v in values))
    return ends.unionByName(open_.join(final, "child").select("id", *((F.col(v) + F.col(f"more_{v}")).alias(v) for v in values)))


def _joined_ids(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ascending, comma-joined conversation ids. SHA-256 is sequential, so a node's ids pass one
    task in the end, but as blocks of text made by many tasks and read one after the other."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, node, size = [], [], None, 0

        def full() -> None:
            out.append((node, held[0], ",".join(map(str, held)).encode()))

        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (i != node or size >= BLOCK):
                    full()
                    held, size = [], 0
                node, size = i, size + 1
                held.append(c)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("id", "first", "ids"), r, strict=True)) for r in out], schema)
                out = []
        if held:
            full()
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "first", "ids"), r, strict=True)) for r in out], schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for i, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if i != node:
                    if running is not None:
                        done.append((node, running.hexdigest()))
                    node, running = i, hashlib.sha256(ids)
                else:
                    running.update(b"," + ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([y for _, y in done])], names=["id", "ends_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["id", "ends_sha256"])

    schema = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])
    cut = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(blocks, "id binary, first long, ids binary")
    return cut.repartition("id").sortWithinPartitions("id", "first").mapInArrow(hashed, "id binary, ends_sha256 string")


def conversation_trie(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of `rebuilt` turns (see `shared_starts`), the root too, with the totals of their subtrees.

    `convs` has every conv_id once, turnless ones included. A conversation that is there twice does not occur: rows of one id are one
    conversation. Null ids take no part, null roles and texts are empty, other columns are ignored, an empty table gives
    no nodes. Long conversations, nodes with many children and many equal conversations are split over tasks; only the
    bytes of one node's joined ids pass one task.
    """
    prefixes = written(_prefixes(rebuilt), "prefixes")
    root = _node(F.lit(0), [F.lit(0)] * 6)
    nodes = prefixes.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("words").alias("words"), F.first("parent").alias("parent"))
    every = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = every.select(root.alias("id"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("words"), F.lit(None).cast("binary").alias("parent"))
    nodes = written(nodes.unionByName(top), "nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "counted")
    totals = subtree_totals(nodes.select("id", "parent", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"])
    depths = prefixes.groupBy("conv_id").agg(F.max_by("id", "depth").alias("id"))
    ends = convs.select("conv_id").join(depths, "conv_id", "left").select(F.coalesce("id", root).alias("id"), "conv_id")
    out = nodes.drop("n_leaves", "saved_tokens").join(totals, "id").join(_joined_ids(ends), "id", "left")
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return out.join(above, "parent", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    convs = table.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return conversation_trie(written(shared_starts(table), "rebuilt"), convs)


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS r, coalesce(role, '') AS role, coalesce("text", '') AS x FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, t.r AS o, t.role, t.x FROM c JOIN t ON t.conv_id = c.base AND t.r <= c.h UNION ALL SELECT c.conv_id, t.r + 10, t.role, t.x FROM c JOIN t ON t.conv_id = c.conv_id AND t.r > c.h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY o) AS depth, x, list({'role': role, 'x': x}) OVER (PARTITION BY conv_id ORDER BY o) AS path FROM b),
p AS (SELECT conv_id, depth, x, path FROM d UNION ALL SELECT conv_id, 0, '', [] FROM c),
n AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * len(regexp_extract_all(any_value(x), '[^\x20\x09-\x0D]+')) AS saved FROM p GROUP BY path),
l AS (SELECT n.conv_id AS kid, n.depth AS kid_depth, n.saved, m.conv_id, m.depth FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth JOIN n m ON m.path = p.path),
k AS (SELECT conv_id, depth, count_if(kid_depth = depth + 1) AS n_children, sum(saved) AS saved_tokens FROM l GROUP BY ALL),
v AS (SELECT l.conv_id, l.depth, count(*) AS n_leaves FROM l JOIN k ON k.conv_id = l.kid AND k.depth = l.kid_depth WHERE k.n_children = 0 GROUP BY ALL),
u AS (SELECT l.kid AS conv_id, l.kid_depth AS depth, l.conv_id AS parent_conv_id FROM l WHERE l.depth = l.kid_depth - 1),
e AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY 1) GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.parent_conv_id, n.n_convs, k.n_children, v.n_leaves, CAST(k.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN k USING (conv_id, depth) JOIN v USING (conv_id, depth) LEFT JOIN u USING (conv_id, depth) LEFT JOIN e USING (path)
"""
