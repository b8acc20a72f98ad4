import re
from collections import defaultdict

import numpy as np
import pytest
from cases import arrow, awkward, awkward_rows, documents, empty, sentence
from moorline.llm.components import components
from moorline.llm.near_duplicates import near_duplicates
from moorline.llm.scratch import Scratch
from moorline.llm.setsketch import REGISTERS, band_keys, band_width, estimates, plausible, sketches
from moorline.llm.words import SPACED, shingle_sets, slices, split_words


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, num, den):
    sets = defaultdict(set)
    for i, text in rows:
        if i is not None:
            sets[i].add(shingles(text))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in ids}


def test_words_and_shingles_match_plain_python():
    texts = [t for _, t, *_ in awkward_rows()]
    for part in slices(arrow(texts), 3000):
        words = split_words(part, SPACED)
        _, bounds = shingle_sets(words)
        for row in range(part.rows):
            assert bounds[row + 1] - bounds[row] == len(shingles(texts[part.first + row]))


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[1000:]
    both, one, two = (sketches(x, np.array([0, len(x)])) for x in (pool, a, b))
    assert (np.maximum(one, two) == both).all()
    n = np.array([2000.0])
    assert abs(estimates(one, two, n, n)[0] - 1 / 3) < 0.12
    assert not plausible(one, two, n, n, 0.8)[0] and plausible(one, one, n, n, 0.8)[0]
    assert sketches(pool[:0], np.array([0, 0])).tolist() == [[0] * REGISTERS]


@pytest.mark.parametrize("least, size", [(0.8, 300), (0.85, 40), (0.85, 7)])
def test_bands_meet_at_the_threshold(least, size):
    rng = np.random.default_rng(size)
    shared = int(np.ceil(2 * size * least / (1 + least)))
    left, right = [], []
    for _ in range(300):
        pool = rng.integers(0, 2**63, 2 * size - shared).astype(np.uint64)
        left.append(pool[:size])
        right.append(pool[size - shared:])
    bounds = np.arange(301) * size
    a, b = sketches(np.concatenate(left), bounds), sketches(np.concatenate(right), bounds)
    keys = [band_keys(x, band_width(least)) for x in (a, b)]
    assert (keys[0] == keys[1]).any(axis=1).all()
    n = np.full(300, float(size))
    assert plausible(a, b, n, n, shared / (2 * size - shared)).all()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def varied(group, count, changes):
    """Copies of one text, each with words of its own at some places."""
    words = sentence(group, 160).split()
    out = []
    for k in range(count):
        copy = list(words)
        for c in range(changes(k)):
            copy[(7 * k + 13 * c) % len(copy)] = f"w{group}x{k}x{c}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("num", [80, 85])
def test_components_match_brute_force(spark, num):
    texts = varied(1, 40, lambda k: k % 4) + varied(2, 12, lambda k: k) + [sentence(s) for s in range(50, 80)] + ["same words here"] * 5
    rows = [((i * 37) % 1009, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in [(2000 + (x[0] or 0), x[1]) for x in awkward_rows()]]
    found = near_duplicates(documents(spark, [(i, t, "s") for i, t in rows]), num=num).collect()
    want = brute(rows, num, 100)
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_awkward_rows(spark):
    found = near_duplicates(awkward(spark)).collect()
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert len(found) == len(rows)
    want = brute(rows, 80, 100)
    for r in found:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    assert near_duplicates(empty(spark)).collect() == []
