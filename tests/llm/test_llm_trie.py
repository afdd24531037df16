"""Prefix tree of rebuilt conversations against a plain Python tree."""

import hashlib
import zlib

import pytest

from voxgauge.llm import prefix_trie


def brute(rows):
    """Nodes by dictionary of prefixes: {path: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, sha)}."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv in turns:
        turns[conv] = [(r, t) for _, _, r, t in sorted(turns[conv])]
    seqs = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seqs[c] = tuple(turns.get(base, [])[:h]) + tuple(turns[c][h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    out = {}
    for p, ms in members.items():
        sub = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * (len(q[-1][1]) if q else 0) for q in sub)
        ends = ",".join(str(c) for c in sorted(c for c in ms if len(seqs[c]) == len(p)))
        out[p] = (
            min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(children[p]),
            sum(1 for q in sub if not children[q]), saved, hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=lambda r: (r[1], r[0], r[7]))


def mine(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("seq", df.turn * 0).withColumn("shard", df.role)  # extra columns with the names used inside
    got = prefix_trie.nodes(spark, df, **kw).collect()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got), key=lambda r: (r[1], r[0], r[7]))


ODD = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "bye"), (0, 3, "assistant", None),
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, None, "other"),
    (2, None, "system", "first"), (2, 0, "user", "hi"), (2, 0, "user", "hi"),  # null turn first, repeated rows
    (3, 5, "user", "b"), (3, 5, "user", "a"),  # a tie of turns: by role, then text
    (None, 0, "user", "lost"), (4, 0, None, None), (5, 0, "user", "é" * 5000),
    (105, 0, "user", "x"), (117, 0, "user", "y"), (117, 1, "user", "z"), (100, 0, "user", "hundred"),
    (250, 0, "user", "alone"),
]


@pytest.mark.parametrize("shard_turns", [prefix_trie.SHARD_TURNS, 1])
def test_odd_rows_against_brute_force(spark, shard_turns):
    assert mine(spark, ODD, shard_turns=shard_turns) == brute(ODD)


def test_large_groups_of_equal_conversations_over_many_shards(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for c in range(300) for t in range(4)]
    rows += [(c, t, "user", f"other {c % 7} {t}") for c in range(300, 420) for t in range(3)]
    assert mine(spark, rows, shard_turns=25) == brute(rows)


def test_empty_and_turnless(spark):
    assert mine(spark, []) == []
    rows = [(1, 0, "user", "q")]  # h = crc32("1") % 6 = 5: its first five turns come from conversation 0, absent
    assert zlib.crc32(b"1") % 6 == 5
    got = mine(spark, rows)
    assert got == brute(rows)
    assert got[0][1] == 0 and got[0][3] == 1 and len(got) == 1  # a member of the root only


def test_registered_query_against_brute_force(spark):
    from voxgauge.llm.queries import QUERIES

    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_trie"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got), key=lambda r: (r[1], r[0], r[7])) == brute(rows)
