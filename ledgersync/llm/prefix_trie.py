"""The trie of conversations' common beginnings, built from burst containers.

A conversation is its sequence of turn ids (a hash of role and text), so texts don't leave the scan. Equal sequences
are merged into one class before anything else. All classes start in the container of the root. A container with more
than ``CONTAINER_TURNS`` turns is burst: the beginning that all its sequences share becomes a chain of trie nodes, and
each next turn id heads a container of its own, until none is too large. The containers that remain are dealt to tasks
by their heads, sorted there by Spark and swept in order: a stack holds the open path, a node is closed when the next
sequence leaves it, and closed nodes hand their counts up. Totals of containers then go up the burst chains, one
grouping for each round of bursts.

Scale: shared beginnings are skipped whole, so rounds grow with the branchings of the large containers and not with
the depth. A task holds the open path and the nodes that wait for their parent to close, so a container's turns bound
it, or the one sequence of a lone class. Copies of a conversation are one row after the first grouping, of which there
is a partial sum in every task. The ids of the members that end at a node are ordered by a range partitioning, packed
into texts of ``PACK`` characters by many tasks, and hashed as a stream. One conversation's turn ids (32 bytes a turn)
form one array.

Defined results: turns are ordered by turn with null first; equal turns by the hash of role and text. Null role or text
is empty; repeated rows are turns of their own. Rows without conv_id belong to no conversation and are left out. An
empty table has no members, so not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import stage, table

CONTAINER_TURNS = 512
PACK = 1 << 16
BATCH = 4_096  # rows a task hands over at once
_NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, each as (turn, id, chars)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.struct("turn", F.substring(F.sha2(content, 256), 1, 32).alias("id"), F.length(text).alias("chars")).alias("t")
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(sequences: DataFrame, shared: Column, base: Column, most: int) -> DataFrame:
    """Each conversation's first ``shared`` turns (up to ``most``) replaced by those of conversation ``base``."""
    heads = sequences.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    joined = sequences.withColumns({"_shared": shared.cast("int"), "_from": base}).join(heads, F.col("_from") == F.col("_base"), "left")
    own = F.expr("IF(size(turns) > _shared, slice(turns, _shared + 1, greatest(size(turns) - _shared, 0)), slice(turns, 1, 0))")
    head = F.expr("IF(_head IS NULL, slice(turns, 1, 0), slice(_head, 1, _shared))")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def _burst(classes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Classes by the container they stay in, and the chains of the burst containers, each by round."""
    settled, chains, open_ = [], [], classes
    while True:
        size = F.size("ids") - F.col("skip") + 1
        found = open_.groupBy("head").agg(
            F.sum(size).alias("turns"), F.count("*").alias("classes"), F.sum("n").alias("n_convs"), F.min("conv").alias("conv"), F.max("skip").alias("skip"),
            F.max("parent").alias("parent"), F.max("up").alias("up"), F.min(F.struct("ids", "chars")).alias("least"), F.max("ids").alias("most"),
        )
        large = found.where((F.col("turns") > CONTAINER_TURNS) & (F.col("classes") > 1))
        jump = F.expr("array_position(zip_with(least.ids, most, (a, b) -> a <=> b), false) - 1").cast("int")  # turns that all share
        large = stage(large.withColumn("jump", jump).withColumn("chars", F.slice("least.chars", 1, F.col("jump"))).drop("least", "most", "turns", "classes"), "trie-chains")
        if large.isEmpty():
            return [*settled, open_], chains
        marks = large.select(F.col("head").alias("_head"), "jump", F.col("conv").alias("_up"))
        marked = stage(open_.join(marks, F.col("head") == F.col("_head"), "left"), "trie-classes")
        settled.append(marked.where("jump IS NULL").select(*open_.columns))
        ended = marked.where("size(ids) = jump").select(F.col("head").alias("_head"), F.col("path").alias("end_path"))  # one for a head at most
        chains.append(large.join(ended, F.col("head") == F.col("_head"), "left").drop("_head"))
        goes_on = marked.where("size(ids) > jump")
        next_head = F.expr("md5(concat(head, '/', array_join(slice(ids, skip + 1, jump + 1 - skip), '')))")
        open_ = goes_on.select("path", "conv", "n", "ids", "chars", next_head.alias("head"), (F.col("jump") + 1).alias("skip"), F.col("head").alias("parent"), F.col("_up").alias("up"))


class _Node:
    __slots__ = ("depth", "chars", "conv", "n", "children", "leaves", "saved", "end", "waiting")

    def __init__(self, depth: int, chars: int) -> None:
        self.depth, self.chars, self.conv, self.n, self.leaves, self.saved, self.children = depth, chars, None, 0, 0, 0, 0
        self.end: str | None = None
        self.waiting: list[_Node] = []  # closed children, until this node's least member is known

    def add(self, conv: int, n: int) -> None:
        self.conv, self.n = conv if self.conv is None else min(self.conv, conv), self.n + n


_SWEPT = "head string, parent string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end_path string"
_TYPES = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _SWEPT.split(", ")])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose classes come in order; head and parent are set for a container's topmost node only."""
    rows: list[tuple] = []
    stack: list[_Node] = []
    ids: list[str] = []
    head = parent = up = None

    def close() -> _Node:
        node = stack.pop()
        node.saved += (node.n - 1) * node.chars
        node.leaves = node.leaves or 1
        rows.extend((None, None, c.conv, c.depth, node.conv, c.n, c.children, c.leaves, c.saved, c.end) for c in node.waiting)
        node.waiting = []
        if stack:
            above = stack[-1]
            above.add(node.conv, node.n)
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + node.leaves, above.saved + node.saved
            above.waiting.append(node)
        return node

    def finish() -> None:
        while stack:
            top = close()
        if head is not None:
            rows.append((head, parent, top.conv, top.depth, up, top.n, top.children, top.leaves, top.saved, top.end))

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(_TYPES)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPES, strict=True)], schema=_TYPES)

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
            skip, chars = row["skip"], row["chars"]
            if row["head"] != head:
                finish()
                head, parent, up = row["head"], row["parent"], row["up"]
                stack, ids = [_Node(skip, chars[skip - 1] if skip else 0)], []
            rest = row["ids"][skip:]
            same = next((k for k, (a, b) in enumerate(zip(ids, rest, strict=False)) if a != b), min(len(ids), len(rest)))
            while len(stack) - 1 > same:
                close()
            ids = rest
            stack += [_Node(skip + k + 1, chars[skip + k]) for k in range(same, len(rest))]
            stack[-1].add(row["conv"], row["n"])
            stack[-1].end = row["path"]
            if len(rows) >= BATCH:
                yield out()
    finish()
    yield out()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order as texts, cut where the path changes or the text is long."""
    path, first, ids, length = None, None, [], 0
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * 3
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["path", "first", "ids"])

    for batch in batches:
        for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (p != path or length > PACK):
                done.append((path, first, ",".join(ids)))
                ids, length = [], 0
            if not ids:
                path, first = p, c
            ids.append(str(c))
            length += len(ids[-1]) + 1
            if len(done) >= (BATCH if length < PACK else 16):
                yield out()
    if ids:
        done.append((path, first, ",".join(ids)))
    yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, digest = None, None
    for batch in batches:
        done = []
        for p, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if p != path:
                if digest:
                    done.append((path, digest.hexdigest()))
                path, digest = p, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"path": pa.array([d[0] for d in done], pa.string()), "ends": pa.array([d[1] for d in done], pa.string())})
    if digest:
        yield pa.RecordBatch.from_pydict({"path": [path], "ends": [digest.hexdigest()]})


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row for each node of the trie over ``sequences`` (conv_id, turns); the columns are those of the contract."""
    ids, chars = F.transform("turns", lambda t: t["id"]), F.transform("turns", lambda t: t["chars"])
    known = sequences.select("conv_id", ids.alias("ids"), chars.alias("chars"))
    known = stage(known.withColumn("path", F.substring(F.sha2(F.array_join("ids", ""), 256), 1, 32)), "trie-sequences")
    copies = known.groupBy("path").agg(F.min("conv_id").alias("conv"), F.count("*").alias("n"))
    classes = copies.join(known.select("conv_id", "ids", "chars"), F.col("conv") == F.col("conv_id")).drop("conv_id")
    root = {"head": F.lit(""), "skip": F.lit(0), "parent": F.lit(None).cast("string"), "up": F.lit(None).cast("long")}
    classes = stage(classes.withColumns(root), "trie-classes")
    settled, chains = _burst(classes)
    columns = ["head", "ids", "chars", "skip", "parent", "up", "path", "conv", "n"]
    waiting = settled[0].select(*columns)
    for more in settled[1:]:
        waiting = waiting.union(more.select(*columns))
    swept = stage(waiting.repartition("head").sortWithinPartitions("head", "ids").mapInArrow(_sweep, _SWEPT), "trie-nodes")
    totals = swept.where("head IS NOT NULL").select("head", "parent", "n_leaves", "saved_tokens")
    nodes = swept.drop("head", "parent")
    above = totals.limit(0)
    for chain in reversed(chains):
        below = totals.union(above).where("parent IS NOT NULL").groupBy(F.col("parent").alias("_parent"))
        below = below.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"), F.count("*").alias("branches"))
        deep = chain.join(below, F.col("head") == F.col("_parent")).withColumn("depth", F.explode(F.sequence("skip", "jump")))
        own = F.expr("IF(depth = 0, 0, chars[depth - 1])").cast("long") * (F.col("n_convs") - 1)
        upward = W.partitionBy("head").orderBy(F.desc("depth"))
        last = F.col("depth") == F.col("jump")
        deep = deep.select(
            "head", "parent", F.col("depth") == F.col("skip"), F.col("conv").alias("conv_id"), F.col("depth").cast("long"),
            F.when(F.col("depth") == F.col("skip"), F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), "n_convs",
            F.when(last, F.col("branches")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
            (F.col("below") + F.sum(own).over(upward)).alias("saved_tokens"), F.when(last, F.col("end_path")).alias("end_path"),
        )
        deep = stage(deep.toDF("head", "parent", "top", *deep.columns[3:]), "trie-upper")
        above = deep.where("top").select("head", "parent", "n_leaves", "saved_tokens")
        nodes = nodes.unionByName(deep.drop("head", "parent", "top"))
    ends = known.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_packed, "path string, first long, ids string")
    ends = ends.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_digests, "path string, ends string")
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    some = nodes.where("end_path IS NOT NULL").join(ends, F.col("end_path") == F.col("path")).select(*result, F.col("ends").alias("ends_sha256"))
    return some.union(nodes.where("end_path IS NULL").select(*result, F.lit(_NO_MEMBERS).alias("ends_sha256")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = sequences(table(spark, sf_dir, "conversations"))
    own = stage(own, "trie-own")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie(rebuilt(own, shared, F.expr("conv_id - conv_id % 100"), 5))


_SQL = """
WITH turn AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, length(coalesce(text, '')) AS chars,
         substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(id || ':' || chars ORDER BY turn NULLS FIRST, id) AS turns FROM turn GROUP BY conv_id),
crc AS (
  SELECT *, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda whole, byte: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(whole, byte)), 4294967295), 4294967295) % 6 AS h
  FROM own),
seq AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefix AS (SELECT conv_id, d, list_slice(turns, 1, d) AS p, len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM seq)),
node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, CASE WHEN d = 0 THEN 0 ELSE CAST(split_part(p[d], ':', 2) AS BIGINT) END AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefix GROUP BY p, d),
child AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
below AS (
  SELECT list_slice(b.p, 1, b.a) AS p, sum((b.n - 1) * b.chars) AS saved, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM node) b LEFT JOIN child c ON c.p = b.p GROUP BY 1)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.p = n.p LEFT JOIN child c ON c.p = n.p LEFT JOIN node u ON n.d > 0 AND u.p = list_slice(n.p, 1, n.d - 1)"""

QUERIES = {"op11_prefix_trie": op11_prefix_trie}
SQL = {"op11_prefix_trie": _SQL}
