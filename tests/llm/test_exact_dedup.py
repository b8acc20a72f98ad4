import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from cases import awkward, awkward_rows, documents, empty, sentence
from moorline.llm import exact_dedup
from moorline.llm.exact_dedup import LONGEST, SHORTEST, chunks, exact_duplicates, without_duplicates


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, digest) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_awkward_rows(spark):
    assert found(exact_duplicates(awkward(spark))) == brute([r[:2] for r in awkward_rows()])


def test_copies_that_differ_in_white_space_or_one_byte(spark):
    long = "\n".join(sentence(i, 80) for i in range(300))
    rows = [(9, long), (3, long.replace("\n", " \t\r\n ")), (5, long + " "), (7, long[:-1] + "Q"), (8, "Q" + long[1:])]
    rows += [(100 + i, sentence(i % 7, 200)) for i in range(60)] + [(50, "a b"), (51, "a b"), (52, "a\x0bb"), (53, "a\x1cb")]
    frame = documents(spark, [(i, t, "s") for i, t in rows])
    assert found(exact_duplicates(frame)) == brute(rows)
    kept = {r[0] for r in brute(rows) if r[3]}
    left = without_duplicates(frame)
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == sorted(kept)


def test_empty_table(spark):
    assert exact_duplicates(empty(spark)).collect() == []


def test_chunks_cover_the_text_and_follow_its_content():
    data = np.random.default_rng(1).integers(97, 123, 200_000).astype(np.uint8).tobytes()
    own = chunks(data)
    assert b"".join(own) == data and max(map(len, own)) <= LONGEST and min(map(len, own[:-1])) >= SHORTEST
    # A passage put in front changes the chunks near it only.
    assert len(set(own) - set(chunks(b"some words in front " + data))) <= 3
    assert chunks(b"") == [] and chunks(b"a") == [b"a"] and b"".join(chunks(b"x" * 50_000)) == b"x" * 50_000


@pytest.mark.parametrize("weak_keys", [1, 3])
def test_identifiers_that_clash_are_never_used(spark, monkeypatch, weak_keys):
    strong, asked = exact_dedup.identifier, []
    # Functions travel by value; the stand-in has all it needs.
    monkeypatch.setattr(exact_dedup, "identifier", lambda chunk, key: b"same id for all!" if key < weak_keys else strong(chunk, key))
    tried = exact_dedup.ambiguous
    monkeypatch.setattr(exact_dedup, "ambiguous", lambda docs, key, text: asked.append(key) or tried(docs, key, text))
    rows = [(i, sentence(i % 5)) for i in range(20)]
    assert found(exact_duplicates(documents(spark, [(i, t, "s") for i, t in rows]))) == brute(rows)
    assert asked == list(range(weak_keys + 1))
