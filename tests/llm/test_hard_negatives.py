import math

import numpy as np
import pytest
from moorline.llm import hard_negatives as module
from moorline.llm.hard_negatives import Best, Tile, hard_negatives


def frame(spark, rows):
    kind = "vec_id long, embedding array<float>, label int, id string, score string, place int"
    return spark.createDataFrame([(i, v, label, "c", "c", 0) for i, v, label in rows], kind)


def brute(rows, k=5, n_positives=5, low=80):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        code = [math.floor(256 * float(np.float32(x))) for x in v]
        if max(map(abs, code)) < 1 << 24:
            row = (label, len(code), np.array(code, np.int32).tobytes(), code)
            own[i] = min(own.get(i, row), row)
    out = []
    for a in own:
        if a % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(own[a][3], c[3])), i, c[0]) for i, c in own.items() if i != a and c[1] == own[a][1]]
        scored.sort()
        for ps, p, _ in [x for x in scored if x[2] == own[a][0]][:n_positives]:
            fits = [(-s, i) for s, i, label in scored if label != own[a][0] and low * -ps <= 100 * -s <= 100 * -ps]
            out += [(a, p, rank, i, -ps, s) for rank, (s, i) in enumerate(fits[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def grouped(rng, n, dim=12, groups=4):
    centres = rng.normal(size=(groups, dim))
    return [(i, (centres[i % groups] + 0.5 * rng.normal(size=dim)).round(2).tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("rows_per_block, step", [(2048, 512), (16, 8)])
def test_matches_brute_force(spark, monkeypatch, rows_per_block, step):
    for name, value in (("SLICE_ROWS", rows_per_block), ("CLUSTER_ROWS", max(2, rows_per_block // 8)), ("STEP", step)):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(12)
    rows = grouped(rng, 260)
    rows += [(1000 + i, rows[20][1], i % 2) for i in range(40)] + [(20, rows[20][1], 9), (30, rows[31][1], 0), (30, rows[31][1], 0)]
    rows += [(2000, None, 1), (2010, [], 1), (2020, [0.0] * 12, 1), (2030, [None] + [1.0] * 11, 1), (2040, [float("nan")] * 12, 0)]
    rows += [(2050, [float("inf")] * 12, 1), (None, rows[0][1], 1), (2060, rows[0][1], None), (2070, [1.0, 2.0], 0), (2080, [2.0, 1.0], 0), (2081, [1.9, 1.0], 1)]
    rows += [(2090, [3e38] * 12, 0), (2100, [65000.0] * 12, 0), (2101, [64000.0] * 12, 0), (2102, [63000.0] * 12, 1), (2103, [-1.0] * 12, 1)]
    got = found(hard_negatives(frame(spark, rows), "vec_id % 10 = 0"))
    assert len(got) > 200 and got == brute(rows)


def test_hot_label_and_other_settings(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in grouped(rng, 150)]
    got = found(hard_negatives(frame(spark, rows), "vec_id % 10 = 0", k=3, n_positives=2, low=50))
    assert got and got == brute(rows, 3, 2, 50)


def test_nothing_to_find(spark):
    assert found(hard_negatives(frame(spark, []), "vec_id % 10 = 0")) == []
    assert found(hard_negatives(frame(spark, [(1, [1.0], 0), (10, [1.0], 0)]), "vec_id % 10 = 0")) == []


def test_a_walk_ends_early_and_misses_nothing():
    rng = np.random.default_rng(7)
    centre = rng.normal(size=16)
    near = np.rint(256 * (centre + 0.05 * rng.normal(size=(40, 16)))).astype(np.int32)
    far = np.rint(256 * (rng.normal(size=(4000, 16)) - centre)).astype(np.int32)
    codes = np.concatenate([far, near])
    blob = lambda x: np.asarray(x, np.int64).tobytes()
    tile = Tile({
        "dim": 16, "ids": blob(range(len(codes))), "labels": blob([0] * len(codes)), "codes": codes.tobytes(),
        "ids_q": blob([90000, 90001]), "labels_q": blob([0, 0]), "codes_q": near[:2].tobytes(), "wanted_q": b"",
    })
    best, walked = Best(np.full(2, module.NONE), 5), 0
    for active, at, scores in tile.walk(lambda: best.need):
        walked += scores.size
        rows, columns = np.nonzero(scores >= best.need[active, None])
        best.offer(active[rows], scores[rows, columns], tile.ids[at][columns])
    exact = near[:2].astype(np.int64) @ codes.T
    want = [sorted(exact[i])[-5:][::-1] for i in range(2)]
    assert [best.scores[best.slots == i].tolist() for i in range(2)] == want
    assert walked < 2 * len(codes) / 3
