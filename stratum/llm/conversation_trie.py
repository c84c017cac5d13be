"""The prefix trie of conversations: what sharing common first turns saves.

1. A turn becomes a digest of 128 bits of its role and text, and its number of words; texts go no further. A
   conversation is the list of these, rebuilt from its head's first turns and its own.
2. Equal conversations become one path with a count and its least conv_id, so copies cost one row.
3. Paths are range-partitioned in their order, hot first turns being split like all else, and each partition is cut into
   shards of a bounded number of turns. A shard is encoded by parentheses (``paren_trie``), and its nodes' members,
   leaves and savings are differences of cumulative arrays.
4. A node may go on in the next shard only if it is on the shard's first or last path. These spines are emitted as
   partial figures and merged by node; what their nodes themselves add to the nodes above them is a sum along each path.
   All other nodes are complete within their shard.

Ids that end at one node are digested in order: ids are joined in runs of neighbouring numbers, and the runs of a node
stream through one hash, the only part that is sequential by its definition.

Defined results: turns of one number are taken in the order of their digests; repeated rows are turns like any other.
Rows without conv_id belong to no conversation and count nowhere. An empty table has no node, not even a root. A
conversation's digests (not its texts) are one row, about 80 bytes a turn. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stratum.llm.common import WORD_SQL, arrow_mapped, schema
from stratum.llm.paren_trie import Parentheses
from stratum.scratch import staged


@dataclasses.dataclass(frozen=True)
class Settings:
    #: conversations of one family start with the first turns of its head, the least id
    family: int = 20
    #: a conversation takes 0 up to one less than this many of them
    heads: int = 4
    #: turns of a shard, but for its last path's
    shard_turns: int = 65_536
    #: neighbouring ids joined in one run
    run: int = 256


def key(path: Column) -> Column:
    """128 bits for a list of turns."""
    return F.substring(F.sha2(F.array_join(F.transform(path, lambda t: t["digest"]), ""), 256), 1, 32)


def rebuilt(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(conv_id, path, path_key) of each conversation, written once."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.col("conv_id") - F.col("conv_id") % settings.family
    turns = (
        conversations.filter("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                F.substring(F.sha2(F.concat_ws(":", F.length(role), role, text), 256), 1, 32).alias("digest"),
                F.regexp_count(text, F.lit(WORD_SQL)).cast("long").alias("words"))
        .withColumn("head", head).repartition("head")
    )
    own = turns.groupBy("head", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("own"))
    firsts = own.filter("conv_id = head").select("head", F.slice("own", 1, max(1, settings.heads - 1)).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string")) % settings.heads).cast("int")
    borrowed = F.coalesce(F.slice("first", F.lit(1), h), F.slice("own", 1, 0))
    path = F.concat(borrowed, F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    found = own.join(firsts, "head", "left").withColumn("path", path).select(
        "conv_id", key(F.col("path")).alias("path_key"),
        F.col("path.digest").alias("digests"), F.col("path.words").alias("words"))
    return staged(found, "conversations")


ENDS = "path_key string, least long, n long, ends_sha256 string"


def ends(convs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For each path its least conversation, their number, and the digest of their ids in order."""
    runs = convs.groupBy("path_key", F.floor(F.col("conv_id") / settings.run).alias("run")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    arrow_schema = to_arrow_schema(schema(ENDS))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, least, n, hashed = None, 0, 0, hashlib.sha256()
        done: list[tuple] = []
        for batch in batches:
            for path_key, ids in zip(batch["path_key"].to_pylist(), batch["ids"].to_pylist()):
                text = ",".join(map(str, ids)).encode()
                if path_key == current:
                    hashed.update(b"," + text)
                    n += len(ids)
                else:
                    if current is not None:
                        done.append((current, least, n, hashed.hexdigest()))
                    current, least, n, hashed = path_key, ids[0], len(ids), hashlib.sha256(text)
            yield table(done, arrow_schema)
            done = []
        if current is not None:
            yield table([(current, least, n, hashed.hexdigest())], arrow_schema)

    in_order = runs.repartition("path_key").sortWithinPartitions("path_key", "run").select("path_key", "ids")
    return arrow_mapped(in_order, digested, schema(ENDS))


def table(rows: list[tuple], arrow_schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in arrow_schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow_schema)], schema=arrow_schema)


#: side is -1 for nodes that are complete, 0 for those on the shard's first path, 1 for those on its last one.
NODES = ("shard long, side int, depth long, node_key string, parent_key string, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved long, words long, ends_sha256 string")


def encoded(paths: list[tuple], shard: int) -> list[tuple]:
    """Rows of ``NODES`` for sorted, distinct (digests, words, n, least, ends_sha256)."""
    depth, words, weight, least, parent, ended = [0], [0], [0], [None], [-1], [None]
    opening, stack, before = [True], [0], []
    for digests, lengths, n, conv_id, ends_sha256 in paths:
        shared = 0
        for a, b in zip(digests, before):
            if a != b:
                break
            shared += 1
        while len(stack) > shared + 1:
            leave(stack, least, opening)
        for at in range(shared, len(digests)):
            parent.append(stack[-1])
            stack.append(len(depth))
            for values, value in ((depth, at + 1), (words, lengths[at]), (weight, 0), (least, None), (ended, None)):
                values.append(value)
            opening.append(True)
        top = stack[-1]
        weight[top] += n
        least[top], ended[top] = lower(least[top], conv_id), ends_sha256
        before = digests
    last = list(stack)
    while stack:
        leave(stack, least, opening)
    first = list(range(len(paths[0][0]) + 1))
    code = Parentheses(np.array(opening))
    open_, close = code.nodes, code.findclose()

    def over_subtree(cumulative: np.ndarray) -> np.ndarray:
        return cumulative[close] - cumulative[open_]

    spine = np.zeros(len(depth), dtype=bool)
    spine[first] = spine[last] = True
    parents, lengths = np.array(parent), np.array(words, dtype=np.int64)
    members = over_subtree(code.over_places(np.array(weight)))
    children = np.bincount(parents[1:][~spine[1:]], minlength=len(depth))
    pairs = code.leaf_ranks()
    leaves = over_subtree(pairs - code.over_places(spine & (pairs[open_ + 1] > pairs[open_])))
    saved = over_subtree(code.over_places(np.where(spine, 0, (members - 1) * lengths)))
    figures = list(zip(members.tolist(), children.tolist(), leaves.tolist(), saved.tolist()))

    rows, keys = [], {}
    for side, nodes, path in ((0, first, paths[0][0]), (1, last, paths[-1][0])):
        hashed, above = hashlib.sha256(), None
        for d, node in enumerate(nodes):
            if d:
                hashed.update(path[d - 1].encode())
            name = hashed.copy().hexdigest()[:32]
            counted = side == 0 or node not in keys
            rows.append((shard, side, d, name, above, least[node] if counted else None, None,
                         *(figures[node] if counted else (0, 0, 0, 0)), words[node], ended[node]))
            keys.setdefault(node, name)
            above = name
    for node in np.flatnonzero(~spine).tolist():
        up = parent[node]
        rows.append((shard, -1, depth[node], None, keys.get(up), least[node], None if up in keys else least[up],
                     *figures[node], None, ended[node]))
    return rows


def lower(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def leave(stack: list[int], least: list, opening: list[bool]) -> None:
    node = stack.pop()
    opening.append(False)
    if stack:
        least[stack[-1]] = lower(least[stack[-1]], least[node])


def shards(paths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of ``NODES``, written once."""
    arrow_schema = to_arrow_schema(schema(NODES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, turns = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for path in zip(*(batch[c].to_pylist() for c in ("digests", "words", "n", "least", "ends_sha256"))):
                held.append(path)
                turns += len(path[0]) + 1
                if turns >= settings.shard_turns:
                    yield table(encoded(held, number), arrow_schema)
                    number, held, turns = number + 1, [], 0
        if held:
            yield table(encoded(held, number), arrow_schema)

    in_order = paths.repartitionByRange("digests").sortWithinPartitions("digests").select(
        "digests", "words", "n", "least", "ends_sha256")
    return staged(arrow_mapped(in_order, cut, schema(NODES)), "trie-shards")


def merged_spines(spine: DataFrame) -> DataFrame:
    """One row for each node on the border of shards."""
    total = staged(spine.groupBy("node_key").agg(
        F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        F.max("words").alias("words"), F.max("ends_sha256").alias("ends_sha256"),
        F.min(F.struct("shard", "side")).alias("owner")), "trie-spines")
    below = total.filter("parent_key is not null").groupBy(F.col("parent_key").alias("node_key")).agg(
        F.count("*").alias("more_children"))
    total = total.join(below, "node_key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more_children", F.lit(0)))
    own = total.select("node_key", "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
                       F.when(F.col("n_children") == 0, 1).otherwise(0).alias("own_leaf"))
    # Each node counts on one path, that of its owner, for itself and all nodes above it there.
    downwards = W.partitionBy("shard", "side").orderBy(F.desc("depth"))
    mine = F.col("owner") == F.struct("shard", "side")
    added = (
        spine.select("node_key", "shard", "side", "depth").join(own, "node_key")
        .select("node_key", *(F.sum(F.when(mine, F.col(c)).otherwise(0)).over(downwards).alias(c)
                              for c in ("own_saved", "own_leaf")))
        .groupBy("node_key").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    )
    return staged(total.join(added, "node_key").select(
        "node_key", "depth", "parent_key", "conv_id", "n_convs", "n_children", "ends_sha256",
        (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"), (F.col("saved") + F.col("own_saved")).alias("saved")),
        "trie-spines")


def trie(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row for each node."""
    convs = rebuilt(conversations, settings)
    paths = staged(convs.join(ends(convs, settings).drop("path_key"), F.col("conv_id") == F.col("least")).drop(
        "conv_id", "path_key"), "paths")
    nodes = shards(paths, settings)
    spine = nodes.filter("side >= 0")
    merged = merged_spines(spine)
    names = merged.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("spine_conv"))
    on_border = spine.select("shard", "node_key").distinct().join(
        merged.select("node_key", F.col("conv_id").alias("spine_conv")), "node_key").withColumnRenamed("node_key", "parent_key")
    complete = nodes.filter("side < 0").join(on_border, ["shard", "parent_key"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "spine_conv"))
    on_spine = merged.join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("spine_conv"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
               F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")]
    return complete.select(*columns).unionByName(on_spine.select(*columns))
