"""Conversation prefix trie: a skeleton of splitter paths, and sorted shards for the rest.

A conversation is a path: one 16-byte digest per turn (role and text), in order.
The paths are dealt over shards by range, after splitters (path, conv_id) that
are quantiles of a bounded sample by hash; the id as second key lets a path
that very many conversations share be split as well. The trie of the splitter
paths is the skeleton and is broadcast: a node that lies in more than one shard
is a prefix of the splitter between them, so every other node is inside one
shard. A shard is read in order, with one stack of open nodes, and finishes its
own nodes; for skeleton nodes it gives partial aggregates, which are added up
by node, and subtree sums of the skeleton are differences of running totals
over its nodes in preorder.

What a task holds: the open path, the finished children of its open nodes (up
to ``WAITING`` each; more are matched with their parent by a join) and a block
of ids. The skeleton has at most shards x ``DEPTH`` nodes, since splitters are
cut after ``DEPTH`` turns. A path is one row of 16 bytes a turn. The ids that
end at a skeleton node are handed on in blocks and hashed as a stream: a SHA-256
of one list can't be split, but nothing of it is held.

Defined results: rows with a NULL conv_id belong to no conversation; NULL roles
and texts are empty; a NULL turn comes first, equal turns are ordered by their
digest and repeated rows are turns of their own; a conversation that is rebuilt
without turns is a member of the root; very long texts are digested in place;
an empty table gives no node, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD_GAP
from ledgerline.sources.tables import materialize

DEPTH = 256                  # turns of a splitter path that the skeleton holds at most
SAMPLED = 32                 # sampled paths per shard
WAITING = 50_000             # finished children that an open node holds
ID_BLOCK = 1000              # ids of one block of a skeleton node's list
TURN = 16                    # bytes of a turn's digest
ROOT = bytes(TURN)
NO_ENDS = hashlib.sha256(b"").hexdigest()

_SCAN = ("kind string, key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, words long, shard long, block long, ids binary")
_FIELDS = [f.split()[0] for f in _SCAN.split(", ")]
_KINDS = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
_SCHEMA = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in _SCAN.split(", ")])


# ----------------------------------------------------------------- paths
def turn_lists(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """(conv_id, turns): per conversation its turns as (digest, words), in order."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    # the length in front keeps ("ab", "c") and ("a", "bc") apart
    digest = F.md5(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "utf-8"))
    words = F.regexp_count(text, F.lit(WORD_GAP.replace("[", "[^")))
    one = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.struct(
            F.col(turn_col).cast("long").alias("turn"), digest.alias("digest"), words.cast("long").alias("words")).alias("one"))
    listed = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(lists: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation with its first h turns taken from the first of its family.

    h is the CRC-32 of the decimal id modulo ``heads``; the first of a family
    is the id rounded down to a multiple of ``family``.
    """
    first = F.col("conv_id") - F.col("conv_id") % family
    leads = lists.where(F.col("conv_id") == first).select(
        F.col("conv_id").alias("lead_id"), F.slice("turns", 1, heads - 1).alias("lead"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % heads).cast("int")
    joined = lists.withColumns({"lead_id": first, "h": h}).join(leads, "lead_id", "left")
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(
        F.coalesce(F.slice("lead", F.lit(1), F.col("h")), none),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def paths_of(lists: DataFrame) -> DataFrame:
    """(conv_id, path, words): the digests of a conversation's turns as one binary, and the words of each turn."""
    return lists.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"))


# -------------------------------------------------------------- skeleton
def splitters_of(paths: DataFrame, shards: int, depth: int = DEPTH) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` quantiles of a sample that the ids' hashes choose (bounded by shards x SAMPLED rows)."""
    sample = (paths.select(F.substring("path", 1, TURN * depth).alias("path"), "conv_id")
              .orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLED * shards).collect())
    ordered = sorted((bytes(r["path"]), r["conv_id"]) for r in sample)
    return sorted({ordered[i * len(ordered) // shards] for i in range(1, shards)}) if ordered else []


def next_key(key: bytes, digest: bytes) -> bytes:
    """Key of a child node: a digest of its parent's key and the turn's digest."""
    return hashlib.blake2b(key + digest, digest_size=TURN).digest()


def skeleton_of(splitters: list[tuple[bytes, int]]) -> list[tuple[bytes, bytes | None, int, int, int]]:
    """(key, parent, preorder number, number of the last node below it, children) of the splitter paths' trie."""
    keys, parents, kids = {b"": ROOT}, {ROOT: None}, {ROOT: 0}
    for path, _ in splitters:
        for at in range(0, len(path), TURN):
            if path[:at + TURN] not in keys:
                parent = keys[path[:at]]
                key = keys[path[:at + TURN]] = next_key(parent, path[at:at + TURN])
                parents[key], kids[key] = parent, 0
                kids[parent] += 1
    ordered = sorted(keys)                 # prefixes come first, so this is preorder
    last = list(range(len(ordered)))
    open_: list[int] = []
    for i, path in enumerate(ordered):
        while open_ and not path.startswith(ordered[open_[-1]]):
            last[open_.pop()] = i - 1
        open_.append(i)
    for i in open_:
        last[i] = len(ordered) - 1
    return [(keys[p], parents[keys[p]], i, last[i], kids[keys[p]]) for i, p in enumerate(ordered)]


# ------------------------------------------------------------------ scan
class Node:
    """An open node of a shard's scan."""

    __slots__ = ("key", "parent", "depth", "words", "skeleton", "conv_id", "n_convs", "n_children", "n_leaves", "saved",
                 "hashed", "ids", "block", "children", "asked")

    def __init__(self, key: bytes, parent: bytes | None, depth: int, words: int, skeleton: bool):
        self.key, self.parent, self.depth, self.words, self.skeleton = key, parent, depth, words, skeleton
        self.conv_id, self.n_convs, self.n_children, self.n_leaves, self.saved = None, 0, 0, 0, 0
        self.hashed, self.ids, self.block, self.children, self.asked = None, [], 0, [], False

    def meet(self, conv_id: int, n: int) -> None:
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)
        self.n_convs += n


def _scan(skeleton: frozenset):
    """An Arrow function over sorted rows (shard, path, conv_id, words) -> finished nodes, partial aggregates and id blocks."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def id_block(node: Node, shard: int) -> None:
            out.append(("ends", node.key, None, None, node.depth, None, None, None, None, None, None, None, shard, node.block,
                        ",".join(map(str, node.ids)).encode()))
            node.ids, node.block = [], node.block + 1

        def give(row: tuple, parent_conv: int | None) -> None:
            out.append(row[:5] + (parent_conv,) + row[6:])

        def close(stack: list[Node], shard: int) -> None:
            node = stack.pop()
            above = stack[-1] if stack else None
            if above:
                above.meet(node.conv_id, node.n_convs)
            if node.skeleton:
                if node.ids:
                    id_block(node, shard)
                out.append(("partial", node.key, node.parent, node.conv_id, node.depth, None, node.n_convs, node.n_children,
                            node.n_leaves, node.saved, None, node.words, shard, None, None))
                return
            for row in node.children:
                give(row, node.conv_id)
            leaves = node.n_leaves + (node.n_children == 0)
            saved = node.saved + (node.n_convs - 1) * node.words
            above.n_children += 1
            above.n_leaves += leaves
            above.saved += saved
            # its key is told only if children that could not wait look for it
            row = ("node", node.key if node.asked else None, node.parent, node.conv_id, node.depth, None, node.n_convs, node.n_children,
                   leaves, saved, node.hashed.hexdigest() if node.hashed else NO_ENDS, None, None, None, None)
            if above.skeleton:
                out.append(("under",) + row[1:])
                return
            above.children.append(row)
            if len(above.children) > WAITING:
                above.asked = True
                out.extend(("late",) + r[1:] for r in above.children)
                above.children = []

        stack: list[Node] = []
        last, now = b"", None
        for batch in batches:
            shards, paths, convs, words = (batch.column(i).to_pylist() for i in range(4))
            for shard, path, conv_id, own in zip(shards, paths, convs, words):
                if shard != now:
                    while stack:
                        close(stack, now)
                    stack, last, now = [Node(ROOT, None, 0, 0, True)], b"", shard
                if path != last:
                    same, most = 0, min(len(path), len(last))
                    while same < most and path[same:same + TURN] == last[same:same + TURN]:
                        same += TURN
                    while len(stack) > same // TURN + 1:
                        close(stack, now)
                    for at in range(same, len(path), TURN):
                        above = stack[-1]
                        key = next_key(above.key, path[at:at + TURN])
                        stack.append(Node(key, above.key, above.depth + 1, own[at // TURN], above.skeleton and key in skeleton))
                    last = path
                node = stack[-1]
                node.meet(conv_id, 1)
                if node.skeleton:
                    node.ids.append(conv_id)
                    if len(node.ids) == ID_BLOCK:
                        id_block(node, now)
                elif node.hashed is None:
                    node.hashed = hashlib.sha256(str(conv_id).encode())
                else:
                    node.hashed.update(b",%d" % conv_id)
                if len(out) >= 20_000:
                    yield _batch(out)
                    out.clear()
        while stack:
            close(stack, now)
        if out:
            yield _batch(out)

    return scanned


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], _FIELDS)


def _hashed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids, sorted by key and place -> key and SHA-256 of the whole list, as a stream."""
    done, key, running = [], None, None
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256(ids)
            else:
                running.update(b"," + ids)
    if key is not None:
        done.append((key, running.hexdigest()))
    if done:
        keys, sums = zip(*done)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], ["key", "ends_sha256"])


# ------------------------------------------------------------------ trie
NODE_COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(paths: DataFrame, shards: int | None = None, depth: int = DEPTH) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path, words)."""
    spark = paths.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = materialize(paths, "paths")
    splitters = splitters_of(paths, shards, depth)
    trie = skeleton_of(splitters)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(splitters, key) for key in zip(path, conv_id.tolist())], dtype="int32")

    dealt = (paths.select(shard_of("path", "conv_id").alias("shard"), "path", "conv_id", "words")
             .repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id"))
    scanned = materialize(dealt.mapInArrow(_scan(frozenset(t[0] for t in trie)), _SCAN), "scan")

    def of(kind: str) -> DataFrame:
        return scanned.where(F.col("kind") == kind)

    places = spark.createDataFrame(trie, "key binary, above binary, number int, last int, kids int").drop("above")
    ends = (of("ends").select("key", "ids", "shard", "block").repartition("key").sortWithinPartitions("key", "shard", "block")
            .select("key", "ids").mapInArrow(_hashed_lists, "key binary, ends_sha256 string"))
    added = of("partial").groupBy("key").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"))
    placed = (added.join(F.broadcast(places), "key").join(ends, "key", "left")
              .withColumn("n_children", F.col("n_children") + F.col("kids"))
              .withColumn("own_leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long"))
              .withColumn("own_saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words")))
    upto = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)   # over the skeleton only
    running = materialize(placed.withColumns({f"sum_{c}": F.sum(f"own_{c}").over(upto) for c in ("leaves", "saved")}), "skeleton")
    below = running.select(F.col("number").alias("last"), F.col("sum_leaves").alias("to_leaves"), F.col("sum_saved").alias("to_saved"))
    keys = running.select(F.col("key").alias("parent"), F.col("conv_id").alias("above_id"))
    skeleton = running.join(F.broadcast(below), "last").join(F.broadcast(keys), "parent", "left").select(
        "conv_id", "depth", F.col("above_id").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("to_leaves") - F.col("sum_leaves") + F.col("own_leaves")).alias("n_leaves"),
        (F.col("to_saved") - F.col("sum_saved") + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))

    def with_parent(rows: DataFrame, parents: DataFrame) -> DataFrame:
        return rows.drop("parent_conv_id").join(parents, "parent").withColumnRenamed("above_id", "parent_conv_id").select(*NODE_COLS)

    asked = scanned.where("kind <> 'partial' AND kind <> 'ends' AND key IS NOT NULL").select(
        F.col("key").alias("parent"), F.col("conv_id").alias("above_id"))
    return (of("node").select(*NODE_COLS).unionByName(with_parent(of("under"), F.broadcast(keys)))
            .unionByName(with_parent(of("late"), asked)).unionByName(skeleton.select(*NODE_COLS)))


def oracle_sql(family: int = 20, heads: int = 4) -> str:
    """Every prefix of every rebuilt conversation, grouped; subtrees by the prefixes of each node."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda c, unused: {step})"
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(id) + 1),
            lambda i: CAST(ascii(substr(id, CAST(i AS INTEGER), 1)) AS BIGINT))), lambda c, b: {byte}))"""
    return f"""
WITH own AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS id,
         list({{'d': d, 'w': w}} ORDER BY turn NULLS FIRST, d) AS turns
  FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL) t
  GROUP BY conv_id),
heads AS (SELECT *, {crc} % {heads} AS h FROM own),
path AS (
  SELECT o.conv_id, coalesce(f.turns, [])[1:o.h] || o.turns[o.h + 1:] AS turns
  FROM heads o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % {family}),
steps AS (
  SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM path),
keyed AS (
  SELECT conv_id, size, depth, array_to_string(list_transform(turns[1:depth], lambda t: t.d), ' ') AS prefix,
         array_to_string(list_transform(turns[1:depth - 1], lambda t: t.d), ' ') AS above, coalesce(turns[depth].w, 0) AS words
  FROM steps),
node AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, any_value(above) AS above, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM keyed GROUP BY depth, prefix),
children AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
own_sums AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, (n_convs - 1) * words AS saved
  FROM node n LEFT JOIN children c USING (depth, prefix)),
over AS (
  SELECT CAST(up AS BIGINT) AS depth, left(prefix, CAST(greatest(33 * up - 1, 0) AS INTEGER)) AS prefix,
         sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM own_sums) u GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, o.n_leaves,
       CAST(o.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM own_sums n JOIN over o USING (depth, prefix)
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.above"""
