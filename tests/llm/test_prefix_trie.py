import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from moorline.llm import prefix_trie as module
from moorline.llm.prefix_trie import ROOT, DoubleArray, prefix_trie
from pyspark.sql import functions as F

KIND = "conv_id long, turn long, role string, text string, n1 string, depth string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "c", 0) for r in rows], KIND)


def crc(conv, most):
    return zlib.crc32(str(conv).encode()) % (most + 1)


def brute(rows, most=8, rebuild=True):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(ts)] for c, ts in turns.items()}
    if rebuild:
        base = own
        own = {c: base.get(c - int(math.fmod(c, 5)), [])[:crc(c, most)] + ts[crc(c, most):] for c, ts in base.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in own.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, convs in members.items():
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rebuilt(df, most=8):
    conv = F.col("conv_id")
    return prefix_trie(df, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % (most + 1), most)


def conversations(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 11:
            rows += [(c, t, "user" if t % 2 else "assistant", f"é{rng.choice('ab')}" * rng.randint(1, 2)) for t in range(rng.randint(1, 9))]
    rows += [(500 + i, t, "system", f"hot {t}") for i in range(80) for t in range(5)]
    rows += [(700, None, "first", "null turn"), (700, -3, None, "x"), (700, 2, "a", None), (700, 9000, "z", ""), (701, 1, None, None), (701, 1, None, None)]
    rows += [(None, 1, "u", "no conversation"), (-7, 1, "u", "below zero"), (-10, 0, "u", "its base"), (703, 0, "u", "short")]
    rows += [(702, t, "user", "long " + str(t % 3) * (40_000 if t == 5 else 1)) for t in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, turns, bits", [(512, 100_000, 12), (3, 50, 1)])
def test_matches_brute_force(spark, monkeypatch, segment, turns, bits):
    for name, value in (("SEGMENT", segment), ("ARRAY_TURNS", turns), ("BLOCK_BITS", bits), ("PIECE_BYTES", 4 * segment)):
        monkeypatch.setattr(module, name, value)
    rows = conversations(1)
    assert found(rebuilt(frame(spark, rows))) == brute(rows)


def test_conversations_as_they_are(spark):
    rows = conversations(2, 40)
    assert found(prefix_trie(frame(spark, rows))) == brute(rows, rebuild=False)


def test_longer_heads(spark):
    rows = conversations(3, 60)
    assert found(rebuilt(frame(spark, rows), most=20)) == brute(rows, most=20)


def test_no_conversations(spark):
    assert found(rebuilt(frame(spark, []))) == []
    assert found(rebuilt(frame(spark, [(None, 1, "u", "x")]))) == []


def test_double_array_holds_exactly_what_was_added():
    rng = np.random.default_rng(3)
    array = DoubleArray(300, 0)
    own = {int(r): {} for r in array.roots(3)}
    level = list(own)
    for _ in range(4):
        pairs = sorted({(int(p), int(c)) for p in level for c in rng.choice(300, rng.choice([0, 1, 1, 2, 40]), replace=False)})
        array.add(*(np.array(x, np.int64) for x in zip(*pairs)))
        level = array.step(*(np.array(x, np.int64) for x in zip(*pairs))).tolist()
        for (p, c), child in zip(pairs, level):
            own[p][c] = child
            assert child not in own
            own[child] = {}
        level = rng.choice(level, min(40, len(level)), replace=False).tolist()
    for slot, children in own.items():
        steps = array.step(np.full(300, slot), np.arange(300))
        assert {c: int(s) for c, s in enumerate(steps) if s != ROOT} == children
