"""Conversation tries against SQL and against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

from tallyshelf.llm import prefix_trie
from tests.llm.cases import SF_DIR, duckdb_result, rows_of

SCHEMA = "conv_id long, turn int, role string, text string, depth string, k1 string, n_convs int"


def frame(spark, rows):
    """With columns whose names the operator uses for itself."""
    return spark.createDataFrame([(*r, "d", "k", 1) for r in rows], SCHEMA).repartition(3)


def by_hand(rows) -> Counter:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own if c % 5 == 0 else turns.get(c - c % 5, [])[:h] + own[h:]
    # Nodes as numbers, by (parent's number, turn).
    numbers, parent, size, members, ends = {}, [None], [0], [[]], [[]]
    for c in sorted(built):
        node = 0
        members[0].append(c)
        for turn in built[c]:
            if (node, turn) not in numbers:
                numbers[node, turn] = len(parent)
                parent.append(node)
                size.append(len(turn[1]))
                members.append([])
                ends.append([])
            node = numbers[node, turn]
            members[node].append(c)
        ends[node].append(c)
    if not built:
        return Counter()
    n = len(parent)
    depth, children, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
        children[parent[k]] += 1
    for k in reversed(range(n)):
        leaves[k] += not children[k]
        saved[k] += (len(members[k]) - 1) * size[k]
        if k:
            leaves[parent[k]] += leaves[k]
            saved[parent[k]] += saved[k]
    return Counter(
        tuple(sorted({
            "conv_id": members[k][0], "depth": depth[k], "parent_conv_id": members[parent[k]][0] if k else None,
            "n_convs": len(members[k]), "n_children": children[k], "n_leaves": leaves[k], "saved_tokens": saved[k],
            "ends_sha256": hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest(),
        }.items()))
        for k in range(n)
    )


def test_trie_of_the_test_conversations(spark):
    query = prefix_trie.q_prefix_trie(spark, SF_DIR)
    assert rows_of(query) == duckdb_result(SF_DIR, prefix_trie.trie_sql())


def test_odd_conversations(spark):
    rows = [
        (5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "assistant", "z"), (5, None, None, None), (5, 2, "user", ""),
        (6, 3, "user", "b"), (7, 1, "u", "x"), (8, 1, "us", "er"), (9, 1, "use", "r"), (9, None, "", ""), (9, None, "", ""),
        (None, 1, "user", "no conversation"), (11, 0, "user", "base is absent"), (12, 0, "user", "ünïcödé " * 3000),
        (-3, 0, "user", "negative"), (0, 0, "user", "zero"), (0, 1, "user", "one"),
    ]
    rows += [(100 + k, t, "user", f"turn {t if t < k % 4 else (t, k)}") for k in range(60) for t in range(k % 11)]
    rows += [(200 + 5 * k, t, "user", f"same {t}") for k in range(40) for t in range(3)]
    # Python's remainder of negative numbers differs from SQL's: -3 belongs to 0 in SQL.
    wanted = by_hand([r for r in rows if r[0] != -3])
    assert rows_of(prefix_trie.conversation_trie(frame(spark, [r for r in rows if r[0] != -3]), shard_turns=16)) == wanted
    assert prefix_trie.conversation_trie(frame(spark, rows)).count() >= len(wanted)


def test_long_conversations_in_several_segments(spark):
    n = 2 * prefix_trie.SEGMENT + 40
    rows = [(5 * k, t, "user", f"t{t}") for k in range(3) for t in range(n)]
    rows += [(100, t, "user", f"t{t}") for t in range(prefix_trie.SEGMENT)]
    rows += [(105, t, "user", f"t{t}" if t < prefix_trie.SEGMENT + 9 else f"other {t}") for t in range(n)]
    rows += [(110, t, "user", f"t{t}" if t < prefix_trie.SEGMENT - 1 else f"more {t}") for t in range(n)]
    rows += [(1, t, "user", f"own {t}") for t in range(n)]
    assert rows_of(prefix_trie.conversation_trie(frame(spark, rows), shard_turns=700)) == by_hand(rows)


def test_no_conversations(spark):
    assert prefix_trie.conversation_trie(frame(spark, [(1, 1, "u", "t")]).limit(0)).collect() == []
