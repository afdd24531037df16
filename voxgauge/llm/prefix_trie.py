"""Shared prefixes of conversations: ternary search trees over dictionary-encoded turns, one per range shard.

``rebuild`` orders the turns of a conversation by ``turn`` (null first; ties by role, then text), reads a null role or
text as empty and drops rows without a conv_id. Conversation c is rebuilt from the first h turns of conversation
c - c % 100 (all if fewer, none if it is absent) and then c's own turns after its first h, h = crc32(decimal c) % 6.

``nodes`` encodes every distinct (role, text) as one id by a written dictionary, so that a conversation is an array of
ids, and deals the conversations to range shards by (ids, conv_id): a large group of equal or similar conversations is
split over several shards like any other run of the order. Each shard builds a ternary search tree of its sequences,
inserting them in median order so that the tree is balanced, and traverses it iteratively, accumulating members,
children, leaves and saved code points from the leaves up. A node all of whose members lie in one shard is finished
there. A node on the path that the first (last) conversation of a shard shares with the previous (next) shard is a
boundary node: its shards give partial sums that add up exactly (a node and a leaf are each counted in one shard:
the node where it first appears, the leaf where its last member lies), merged by a 128-bit fingerprint of the path.

One row per node (prefix of d rebuilt turns, d = 0 the root): conv_id (smallest member), depth, parent_conv_id (null
for the root), n_convs, n_children, n_leaves (childless nodes of its subtree), saved_tokens (over the subtree, each
node's (n_convs - 1) times the code points of its last text), ends_sha256 (SHA-256 of the decimal conv_ids, ascending,
comma-joined, of the members with exactly d turns; none: the hash of the empty string). A turnless conversation is a
member of the root only. Repeated rows are repeated turns. No conversations: no rows. The ids that end at one node are
hashed in one task (SHA-256 is sequential), about 10 bytes a member of that node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from voxgauge.llm.shared import broadcast_if_small, stored

#: Rebuilt turns for one shard, about; the shards are at least the session's shuffle partitions.
SHARD_TURNS = 200_000
#: Fixed values of the contract: conversations are rebuilt from their hundred's first, h = crc32 % HEADS turns.
BLOCK, HEADS = 100, 6

_NODE = (
    "boundary boolean, fp_hi long, fp_lo long, parent_hi long, parent_lo long, parent_boundary boolean, depth long, "
    "conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, shard int"
)


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, role, text) of every rebuilt conversation; ``ids``: every conv_id, turnless ones too."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.withColumn("pos", F.row_number().over(order)).drop("turn")
    ids = turns.select("conv_id").distinct().select(
        F.col("conv_id").alias("c"),
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"),
    )
    heads = turns.filter(F.col("pos") <= HEADS - 1).join(ids, turns.conv_id == ids.base).filter(F.col("pos") <= F.col("h"))
    own = turns.join(ids, turns.conv_id == ids.c).filter(F.col("pos") > F.col("h"))
    keep = [F.col("c").alias("conv_id"), "pos", "role", "text"]
    return heads.select(*keep).unionByName(own.select(*keep)), ids.select(F.col("c").alias("conv_id"))


def _fingerprint(parent: int, turn: int) -> int:
    return xxhash.xxh3_128_intdigest(parent.to_bytes(16, "little") + turn.to_bytes(8, "little", signed=True))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _common(a, b) -> int:
    """Length of the common prefix of two sequences; -1 if there is no other sequence."""
    if b is None:
        return -1
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def shard_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard: rows of kind 0 are its conversations (sorted here), -1 and 1 the neighbours' sequences."""
    shard = int(rows["shard"].iloc[0])
    around = {int(k): (None if s is None else tuple(s)) for k, s in zip(rows["kind"], rows["seq"]) if k != 0}
    members = rows[rows["kind"] == 0]
    convs = sorted(
        ((tuple(int(t) for t in s), int(c), tuple(int(x) for x in n)) for s, c, n in zip(members["seq"], members["conv_id"], members["lens"])),
    )
    if not convs:
        return pd.DataFrame(columns=[f.split()[0] for f in _NODE.split(", ")])
    # the tree: node 0 is the root; split id, children lo / eq / hi, trie parent, depth, text length, fingerprint
    split, lo, eq, hi, up, depth, length, fp = [0], [-1], [-1], [-1], [-1], [0], [0], [0]
    ends: dict[int, list[int]] = {}
    paths: dict[int, list[int]] = {}

    def new(turn: int, parent: int, chars: int) -> int:
        split.append(turn), lo.append(-1), eq.append(-1), hi.append(-1), up.append(parent)
        depth.append(depth[parent] + 1), length.append(chars), fp.append(_fingerprint(fp[parent], turn))
        return len(split) - 1

    def insert(index: int) -> None:
        seq, conv, lens = convs[index]
        at, path = 0, [0]
        for turn, chars in zip(seq, lens):
            cur = eq[at]
            if cur < 0:
                cur = eq[at] = new(turn, at, chars)
            else:
                while split[cur] != turn:
                    side = lo if turn < split[cur] else hi
                    if side[cur] < 0:
                        side[cur] = new(turn, at, chars)
                    cur = side[cur]
            at = cur
            path.append(at)
        ends.setdefault(at, []).append(conv)
        if index in (0, len(convs) - 1):
            paths[index] = path

    spans = [(0, len(convs))]  # median first, then the medians of both halves: a balanced tree
    while spans:
        a, b = spans.pop()
        if a < b:
            m = (a + b) // 2
            insert(m)
            spans += [(m + 1, b), (a, m)]
    continued, continuing = set(), set()
    first_common = _common(convs[0][0], around.get(-1))
    last_common = _common(convs[-1][0], around.get(1))
    continued.update(node for node in paths[0] if depth[node] <= first_common)
    continuing.update(node for node in paths[len(convs) - 1] if depth[node] <= last_common)

    order, stack = [], [0]  # iterative traversal through lo, eq and hi; children of a node come after it
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in (hi[node], eq[node], lo[node]) if c >= 0]
    n = len(split)
    convs_n, kids, leaves, saved, least, has_kids = [0] * n, [0] * n, [0] * n, [0] * n, [None] * n, [False] * n
    for node in reversed(order):
        mine = ends.get(node, [])
        convs_n[node] += len(mine)
        if mine:
            least[node] = min(mine) if least[node] is None else min(least[node], min(mine))
        if node not in continuing and not has_kids[node]:
            leaves[node] += 1
        saved[node] += convs_n[node] * length[node] - (0 if node in continued else length[node])
        if node:
            parent = up[node]
            convs_n[parent] += convs_n[node]
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
            kids[parent] += 0 if node in continued else 1
            has_kids[parent] = True
            least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
    out = []
    for node in order:
        boundary = node in continued or node in continuing
        parent = up[node]
        mine = ",".join(str(c) for c in sorted(ends.get(node, [])))
        out.append((
            boundary, _signed(fp[node] >> 64), _signed(fp[node] & ((1 << 64) - 1)),
            None if parent < 0 else _signed(fp[parent] >> 64), None if parent < 0 else _signed(fp[parent] & ((1 << 64) - 1)),
            parent >= 0 and (parent in continued or parent in continuing), depth[node], least[node],
            None if parent < 0 else least[parent], convs_n[node], kids[node], leaves[node], saved[node],
            mine if boundary else hashlib.sha256(mine.encode()).hexdigest(), shard,
        ))
    fields = [f.split() for f in _NODE.split(", ")]
    # straight from Python ints: nulls of the root would otherwise make floats of 64-bit fingerprints
    return pd.DataFrame({
        name: pd.array([row[i] for row in out], dtype="Int64" if kind == "long" else None)
        for i, (name, kind) in enumerate(fields)
    })


def nodes(spark: SparkSession, conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix tree of the rebuilt conversations, as the module describes."""
    turns, ids = rebuild(conversations)
    turns = stored(spark, "trie-turns", turns)
    words = stored(spark, "trie-words", turns.select("role", "text").distinct().withColumn("tid", F.monotonically_increasing_id()))
    coded = turns.join(words, ["role", "text"]).select("conv_id", "pos", "tid", F.char_length("text").cast("long").alias("n"))
    seqs = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "n"))).alias("t"))
    seqs = ids.join(seqs, "conv_id", "left").select(
        "conv_id",
        F.coalesce(F.transform("t", lambda x: x.tid), F.array().cast("array<long>")).alias("seq"),
        F.coalesce(F.transform("t", lambda x: x.n), F.array().cast("array<long>")).alias("lens"),
    )
    total = turns.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    dealt = stored(
        spark, "trie-shards",
        seqs.repartitionByRange(shards, "seq", "conv_id").withColumn("shard", F.spark_partition_id()),
    )
    ends = dealt.groupBy("shard").agg(F.min(F.struct("seq", "conv_id")).alias("first"), F.max(F.struct("seq", "conv_id")).alias("last"))
    line = W.orderBy("shard")  # one row per shard
    ends = ends.select("shard", F.lag("last.seq").over(line).alias("before"), F.lead("first.seq").over(line).alias("after"))
    around = ends.select("shard", F.lit(-1).alias("kind"), F.lit(None).cast("long").alias("conv_id"), F.col("before").alias("seq"))
    around = around.unionByName(ends.select("shard", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("conv_id"), F.col("after").alias("seq")))
    rows = dealt.select("shard", F.lit(0).alias("kind"), "conv_id", "seq", "lens").unionByName(
        around.withColumn("lens", F.lit(None).cast("array<long>"))
    )
    found = stored(spark, "trie-nodes", rows.groupBy("shard").applyInPandas(shard_nodes, _NODE))
    merged = (
        found.filter("boundary")
        .groupBy("fp_hi", "fp_lo")
        .agg(
            F.first("depth").alias("depth"), F.first("parent_hi").alias("parent_hi"), F.first("parent_lo").alias("parent_lo"),
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
            F.sha2(F.concat_ws(",", F.transform(
                F.filter(F.array_sort(F.collect_list(F.struct("shard", "ends"))), lambda x: x.ends != ""), lambda x: x.ends
            )), 256).alias("ends_sha256"),
        )
    )
    merged = stored(spark, "trie-boundary", merged)
    parents = broadcast_if_small(merged.select(F.col("fp_hi").alias("parent_hi"), F.col("fp_lo").alias("parent_lo"), F.col("conv_id").alias("p")))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = found.filter("not boundary").withColumnRenamed("ends", "ends_sha256")
    inner = inner.join(parents, ["parent_hi", "parent_lo"], "left").withColumn(
        "parent_conv_id", F.when(F.col("parent_boundary"), F.col("p")).otherwise(F.col("parent_conv_id"))
    )
    outer = merged.join(parents, ["parent_hi", "parent_lo"], "left").withColumn("parent_conv_id", F.col("p"))
    return inner.select(*cols).unionByName(outer.select(*cols))
