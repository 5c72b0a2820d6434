"""findclose and range minima by direct search; the trie equals brute force for every shard size."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from loadcast.llm.conversation_trie import prefix_trie
from loadcast.llm.parentheses import Minima, encode, findclose, parents

SCHEMA = "conv_id long, turn long, role string, text string"


def stack(bits):
    close, parent, open_, above = [], [], [], []
    for place, bit in enumerate(bits):
        if bit:
            parent.append(above[-1] if above else -1)
            above.append(len(open_))
            open_.append(place)
            close.append(-1)
        else:
            close[above.pop()] = place
    return close, parent


@pytest.mark.parametrize("n, longest", [(1, 0), (1, 5), (2, 1), (300, 4), (40, 400), (4000, 9)])
def test_parentheses(n, longest):
    draw = random.Random(n)
    found = {
        tuple(draw.choice("ab") for _ in range(draw.randint(min(1, longest), longest)))
        for _ in range(n)
    }
    texts = sorted(found)
    common = [0]
    for a, b in zip(texts, texts[1:]):
        common.append(next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))
    bits = encode(np.array([len(t) for t in texts]), np.array(common))
    close, parent = stack(bits)
    assert findclose(bits).tolist() == close
    nodes = sorted({t[:k] for t in texts for k in range(len(t) + 1)})
    assert len(nodes) == len(close)
    assert parents(np.array([len(t) for t in nodes])).tolist() == parent


def test_deep_and_wide():
    for bits in ([True] * 5000 + [False] * 5000, [True] + [True, False] * 5000 + [False]):
        assert findclose(np.array(bits)).tolist() == stack(bits)[0]


def test_minima():
    draw = np.random.default_rng(3)
    values = draw.integers(-50, 50, 333)
    low = draw.integers(0, 333, 500)
    high = low + 1 + draw.integers(0, 400, 500) % (333 - low)
    want = [values[a:b].min() for a, b in zip(low, high)]
    assert Minima(values).of(low, high).tolist() == want


def brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    for turns in own.values():
        turns.sort()
    members, ends = {}, {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = own.get(conv - (abs(conv) % 20) * (1 if conv >= 0 else -1), [])
        path = tuple(t[3:] for t in base[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
        ends.setdefault(path, []).append(conv)
    below, saved, leaves = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = saved.get(path, 0) + (len(members[path]) - 1) * words
        leaves[path] = leaves.get(path, 0) or 1
        if path:
            up = path[:-1]
            below[up] = below.get(up, 0) + 1
            saved[up] = saved.get(up, 0) + saved[path]
            leaves[up] = leaves.get(up, 0) + leaves[path]
    return sorted(
        (
            min(convs), len(path), min(members[path[:-1]]) if path else -1, len(convs),
            below.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


def found(spark, rows, shard_turns):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.selectExpr("*", "'x' AS key", "1 AS n", "2 AS depth", "'y' AS class", "3 AS words")
    got = prefix_trie(df, shard_turns).fillna(-1, ["parent_conv_id"]).collect()
    return sorted(tuple(r) for r in got)


def talks():
    draw = random.Random(8)
    rows = [(None, 0, "user", "no id"), (3, None, None, None), (3, None, "user", "null turn")]
    rows += [(3, 0, None, "tie"), (3, 0, "user", None), (3, 0, "user", None), (3, 1, "a", "b c\td")]
    for conv in [*range(20, 140), 170, 171, 172, 300, 303, -7, -20, -25]:
        for turn in range(draw.choice([1, 2, 2, 3, 5, 8])):
            word = draw.choice(["hello there", "ok", "why not so", ""])
            rows.append((conv, turn * 2, "user" if turn % 2 else "system", word))
    for conv in range(400, 480):  # copies, heads included
        rows += [(conv, t, "user", f"same text {t}") for t in range(4)]
    rows += [(500, t, "user", f"turn {t} of many") for t in range(700)]
    rows += [(501, t, "user", f"turn {t} of many") for t in range(650)]
    return rows


@pytest.mark.parametrize("shard_turns", [1 << 18, 200, 7])
def test_equals_brute_force(spark, shard_turns):
    rows = talks()
    random.Random(1).shuffle(rows)
    assert found(spark, rows, shard_turns) == brute(rows)


def test_turnless_conversations_and_long_text(spark):
    rows = [(c, 0, "user", "w " * 50_000 + str(c % 2)) for c in range(1, 20)]
    assert found(spark, rows, 3) == brute(rows)


def test_empty_table(spark):
    assert found(spark, [], 10) == []
