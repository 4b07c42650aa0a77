"""The conversation trie against a plain version that builds every prefix."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import pytest

from tickloom.llm import conversation_trie as trie

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(rows: list[tuple]) -> set[tuple]:
    """Nodes as (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: (t[:2], tie(t[2], t[3])))] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * size
    return {
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    }


def tie(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def found(spark, rows: list[tuple], **kw) -> list[tuple]:
    return [tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, COLUMNS), **kw).collect()]


def varied(n: int) -> list[tuple]:
    rows = []
    for c in range(n):
        for k in range(c * 7 % 12):
            rows.append((c, k, "user" if k % 2 == 0 else None, f"é{(c // (3 + k)) % 4} {k}" if c % 11 else None))
    return rows


@pytest.mark.parametrize("block", [1, 4])
def test_nodes_equal_the_plain_version(spark, block):
    rows = varied(90) + [(200, k, "user", f"turn {k // 2}") for k in range(2_600)] + [(203, k, "user", f"turn {k // 2}") for k in range(1_500)]
    rows += [(None, 1, "user", "x"), (7, None, "user", "first"), (7, 3, "user", "b"), (7, 3, "user", "a"), (7, 3, "user", "a"), (-3, 0, "user", "minus")]
    got = found(spark, rows, block=block)
    assert len(got) == len(set(got))
    assert set(got) == plain(rows)


def test_equal_conversations_and_hot_turns(spark, monkeypatch):
    monkeypatch.setattr("tickloom.llm.skew.HOT_ROWS", 20)
    rows = [(c, k, "user", f"same {k}") for c in range(400) for k in range(9)] + [(c, k, "user", f"own {c if k else 0} {k}") for c in range(400, 700) for k in range(10)]
    assert set(found(spark, rows)) == plain(rows)


def test_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_extra_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a", 5, "x")], COLUMNS + ", depth long, digest string")
    assert trie.conversation_trie(rows).count() == 1 + (zlib.crc32(b"1") % 9 == 0)
