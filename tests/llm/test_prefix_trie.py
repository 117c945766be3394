import hashlib
import random
import zlib
from collections import defaultdict

from tillstar.llm import prefix_trie

KIND = "conv_id long, turn long, role string, text string, rep string, x long, task int"


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = said.get(c - c % 5, [])[:h] + said[c][h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = {n: [m for m in below if len(m) == len(n) + 1 and m[: len(n)] == n] for n in below}
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not v for v in children.values()), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "r", 1, 2) for r in rows], KIND)
    return sorted(map(tuple, prefix_trie.prefix_trie(frame).collect()), key=repr)


def test_equals_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for conv in range(40):
        for turn in range(draw.choice((1, 2, 5, 9, 12))):
            rows.append((conv * draw.choice((1, 1, 3)), turn, draw.choice(("user", "assistant")), draw.choice(("a", "é", "", "some words"))))
    assert found(spark, rows) == brute_force(rows)


def test_special_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "x"),
        (5, 3, "user", "y" * 100_000), (6, 1, "", ""), (6, None, None, ""), (12345678901, 0, "u", "z"), (14, 0, "user", "z"),
    ]
    assert found(spark, rows) == brute_force(rows)


def test_long_conversation_and_copies(spark):
    rows = [(conv, t, "user", str(t % 7)) for conv in range(10, 22) for t in range(3)]
    rows += [(0, t, "user", str(t)) for t in range(300)] + [(1, t, "user", str(t)) for t in range(299)]
    assert found(spark, rows) == brute_force(rows)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "hi") for c in range(101, 140) if c % 5]  # no conversation begins a group
    result = found(spark, rows)
    assert result == brute_force(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in result)


def test_empty_table(spark):
    assert found(spark, []) == []
