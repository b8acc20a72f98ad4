import hashlib
import re

import numpy as np
from cases import awkward, awkward_rows, documents, empty, sentence
from moorline.llm import decontamination
from moorline.llm.decontamination import contamination, decontaminate
from moorline.llm.fm_index import FmIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, width=10):
    windows = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + width]), set()).add(str(name))
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for window, names in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k:k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found |= names
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, sentence(900, 30)), (2, sentence(901, 12)), (10, "Short ITEM"), (3, None), (4, ""), (5, "..."), (2, sentence(901, 12)), (None, sentence(902, 11)), (7, "the the the the")]


def planted():
    inside = " ".join(ITEMS[0][1].split()[5:18])
    return [
        (1, sentence(1) + " " + inside.upper() + " " + sentence(2)), (2, ITEMS[1][1]), (3, "a short, item!"), (4, sentence(3)), (5, ITEMS[7][1] * 2 + " x"),
        (6, " ".join([ITEMS[0][1], ITEMS[0][1]])), (7, "the the the the the the"), (8, inside.replace(" ", " -- ")), (9, "\n".join(inside.split()[:9])), (1, ITEMS[0][1]),
    ]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 3000)
    text[rng.integers(0, 3000, 60)] = 0
    text[-1] = 0
    index = FmIndex(text, 6)
    lengths = rng.integers(1, 8, 200)
    starts = np.cumsum(lengths) - lengths
    symbols = rng.integers(1, 6, lengths.sum())
    low, high = index.search(symbols, starts, lengths)
    for k in range(200):
        phrase = symbols[starts[k]:starts[k] + lengths[k]].tolist()
        want = [i for i in range(len(text)) if text[i:i + len(phrase)].tolist() == phrase]
        got = sorted(index.locate(np.arange(low[k], max(low[k], high[k]))).tolist())
        assert got == want


def check(spark, rows, docs, items):
    found = [tuple(r)[:6] for r in contamination(docs, benchmark(spark, items)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(brute(rows, items), key=key)


def test_hits_match_brute_force(spark):
    check(spark, planted(), documents(spark, [(i, t, "s") for i, t in planted()]), ITEMS)


def test_blocks_of_the_benchmark_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 150)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 20)
    check(spark, planted(), documents(spark, [(i, t, "s") for i, t in planted()]), ITEMS)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    check(spark, rows, awkward(spark), ITEMS + [(50, rows[0][1])])
    check(spark, rows, awkward(spark), [])
    assert contamination(empty(spark), benchmark(spark, ITEMS)).collect() == []


def test_cut_texts_are_clean_and_others_stay(spark):
    docs = documents(spark, [(i, t, "s") for i, t in planted()])
    cut = decontaminate(docs, benchmark(spark, ITEMS))
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[4] == dict(planted())[4] and texts[2].strip() == ""
    again = contamination(cut, benchmark(spark, [i for i in ITEMS if i[0] == 1])).collect()
    assert not any(r.contaminated for r in again)
    odd = decontaminate(awkward(spark), benchmark(spark, ITEMS))
    assert sorted(map(str, odd.collect())) == sorted(map(str, awkward(spark).collect()))
