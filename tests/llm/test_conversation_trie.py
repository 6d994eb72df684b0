import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import rows

from ledgerloom.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def paths(data):
    """The rebuilt conversations of (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c in own:
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(data):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, path in paths(data).items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                children[tuple(path[:d - 1])].add(tuple(path[:d]))
        ends[tuple(path)].append(c)
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        size = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += size
    return Counter((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]),
                    leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
                   for node, who in members.items())


def both(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    for c in ("c", "d", "key", "name", "depth", "range"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    got = Counter(tuple(r) for r in trie.trie(df.repartition(6)).collect())
    assert got == brute(data)


ODD = ([(None, 1, "user", "lost"), (0, None, "user", "first"), (0, None, None, None), (0, 3, "a", "x"), (0, 3, "a", "x"),
        (0, 1, "ab", "c"), (0, 2, "a", "bc"), (7, 1, "", ""), (7, 2, None, ""), (-3, 1, "u", "n"), (-5, 9, "u", "é漢")]
       + [(10 + i, t, "user", "same") for i in range(40) for t in range(i % 9)]
       + [(100, t, "user", f"m{t % 3}") for t in range(700)] + [(101, t, "user", f"m{t % 3}") for t in range(1300)]
       + [(102, t * 1000, "user", f"m{t % 3}") for t in range(70)] + [(104, t, "u", "tail") for t in range(64)]
       + [(200 + 5 * i, 0, "user", "hello") for i in range(3000)])


@pytest.mark.parametrize("fan", [2, 64])
def test_odd_input(spark, monkeypatch, fan):
    """Nulls, ties, repeated rows, copies, long conversations, blocks in one and in many levels of groups."""
    monkeypatch.setattr(trie, "FAN", fan)
    both(spark, ODD)


def test_given_table(spark):
    both(spark, [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows("conversations", "/root/testdata/sf0.01")])


def test_block_borders(spark):
    data = [(c, t, "u", "x" if t < 16 else f"{c}") for c, n in ((5, 8), (10, 9), (15, 16), (20, 17), (25, 16), (30, 8))
            for t in range(n)]
    both(spark, data)


def test_ends_stream_in_order(spark):
    ids = [*range(-3000, 5000, 3), 10**15]
    df = spark.createDataFrame([(b"n", i) for i in reversed(ids)] + [(b"m", 4)], "name binary, c long").repartition(5)
    got = {bytes(r[0]): r[1] for r in trie.ends_sha(df).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   b"m": hashlib.sha256(b"4").hexdigest()}


def test_empty(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
