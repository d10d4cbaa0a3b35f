"""The conversation trie against brute force, and on odd input."""

import hashlib
import zlib
from collections import defaultdict

import pandas as pd
import pytest

from lakeops.llm import queries, trie

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, item string, pos string, name string"


def item(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def slow_trie(rows):
    """Nodes by whole prefixes, each node's totals over all nodes below it."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, item(role, text), len(text or "")))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    line = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        line[c] = convs.get(c - int(c - 100 * int(c / 100)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, ts in line.items():
        for d in range(len(ts) + 1):
            members[tuple(t[0] for t in ts[:d])].append(c)
    out = {}
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        ends = sorted(c for c in who if len(line[c]) == len(p))
        out[min(who), len(p)] = (
            min(members[p[:-1]]) if p else None, len(who), len(children),
            sum(all(q == r or r[:len(q)] != q for r in below) for q in below),
            sum((len(members[q]) - 1) * line[min(members[q])][len(q) - 1][1] for q in below if q),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def nodes(frame):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect()}


def test_nodes_equal_brute_force(spark):
    t = pd.read_parquet(f"{SF}/conversations.parquet")
    want = slow_trie(t[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None))
    got = nodes(queries.QUERIES["op13_conversation_trie"](spark, SF))
    assert got == want and len(got) > 20


ODD = [
    # null and tied turns, null role and text, a repeated row, a null conv_id
    (1, None, None, None), (1, None, "a", "first"), (1, 0, "a", "x"), (1, 0, "a", "x"), (1, 5, None, "z"),
    (2, 3, "a", "x"), (2, 3, "a", "w"), (2, None, "user", ""), (None, 0, "a", "nobody's"),
    (100, 0, "ab", "c"), (101, 0, "a", "bc"), (102, 0, "a", "bc"), (103, 1, "a", "☃😀"), (103, 2, "b", "long " * 40_000),
    (-7, 0, "a", "x"), (-7, 1, "a", "y"), (-100, 0, "a", "x"),
    *((300 + i, j, "u", f"{j}" if j < 4 else f"{j} of {i % 3}") for i in range(40) for j in range(i % 9)),
    # one conversation far longer than the others, and one that starts with it
    *((700, j, "u", f"turn {j % 7}") for j in range(75)), *((701, j, "u", f"turn {j % 7}") for j in range(70)),
]


def test_odd_input(spark):
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in ODD], TURNS)
    assert nodes(trie.rebuilt_trie(frame.repartition(5))) == slow_trie(ODD)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")]])
def test_no_conversation_no_node(spark, rows):
    assert trie.rebuilt_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).count() == 0


def test_turnless_conversations_are_the_root(spark):
    """Conversation 5 has as many turns as are cut off, and conversation 0 is
    not there: nothing is left of it."""
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 99)}
    c = next(c for c in h if h[c] == 5)
    got = nodes(trie.rebuilt_trie(spark.createDataFrame([(c, i, "a", "b") for i in range(5)], "conv_id int, turn int, role string, text string")))
    assert got == {(c, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}
