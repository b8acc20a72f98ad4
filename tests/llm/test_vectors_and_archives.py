import hashlib

import numpy as np
import pytest
from moorline.llm import vector_search
from moorline.llm.vector_search import nearest
from moorline.llm.warc import VERSION, read_archives, round_trip, write_archives
from moorline.session import scratch_path


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "c", 0) for i, v in rows], "vec_id long, embedding array<float>, id string, label int")


def brute(rows, k, asked):
    own = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            own.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = []
    for q in filter(asked, own):
        scores = {}
        for c in own:
            pairs = [a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) for a in own[q] for b in own[c] if len(a) == len(b)]
            if c != q and pairs:
                scores[c] = max(pairs)
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, rank, c, round(s, 9)) for rank, (c, s) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("rows_per_block", [4096, 7])
def test_nearest_is_exact(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(vector_search, "CANDIDATE_ROWS", rows_per_block)
    monkeypatch.setattr(vector_search, "QUERY_ROWS", rows_per_block)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).round(1).tolist()) for i in range(120)]
    rows += [(200 + i, rows[10][1]) for i in range(9)] + [(300, [2 * x for x in rows[10][1]]), (10, rows[10][1]), (50, rng.normal(size=16).tolist())]
    rows += [(400, None), (410, []), (420, [0.0] * 16), (430, [None] + [1.0] * 15), (440, [float("nan")] * 16), (450, [float("inf")] * 16), (None, rows[0][1])]
    rows += [(460, [1.0, 2.0]), (470, [2.0, 1.0]), (480, [1e-30] * 16), (490, [3e38] * 16)]
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest(vectors(spark, rows), "vec_id % 10 = 0").collect())
    assert found == brute(rows, 5, lambda i: i % 10 == 0)


def test_no_vectors(spark):
    assert nearest(vectors(spark, []), "vec_id % 50 = 0").collect() == []
    assert nearest(vectors(spark, [(50, [1.0])]), "vec_id % 50 = 0").collect() == []


FAKE = f"{VERSION}WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages():
    rows = [
        (1, "http://a/1", "x" * 1500), (2, "u2", "x" * 1500), (3, None, None), (4, "u", "a" * 999), (5, "u", "a" * 999), (None, "n", "x" * 1500),
        (6, "b\r\nX: y", "pre " + FAKE + " post " + FAKE * 3 + VERSION + "nope" + "z" * 5000), (7, "é", "é€" * 800), (8, "u", ""), (2, "u2", "x" * 1500), (None, None, None),
    ]
    return rows + [(100 + i, f"u{i}", f"p{i} " * (i % 50) + (FAKE if i % 7 == 0 else "")) for i in range(80)]


def expected(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            first[data] = max(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        again = to is not None and to != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def got(frame):
    rows = frame.collect()
    assert all(r.digest_ok for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


@pytest.mark.parametrize("codec, split", [("gzip", "128m"), ("none", "3000")])
def test_archives_round_trip(spark, codec, split):
    rows = pages()
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, id string, digest int").coalesce(2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert got(round_trip(frame) if codec == "gzip" else _plain(spark, frame)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _plain(spark, frame):
    path = scratch_path(spark, "archives")
    write_archives(frame, path, "none")
    return read_archives(spark, path)


def test_bytes_after_a_broken_record_are_not_reached(spark, tmp_path):
    record = f"{VERSION}WARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
    broken = f"{VERSION}WARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 400\r\n\r\nshort\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(((record % 1) + (record % 2) + broken + (record % 3)).encode())
    (tmp_path / "b.warc").write_bytes(b"no archive at all\r\n\r\n" + (record % 4).encode())
    ids = {r.page_id for r in read_archives(spark, str(tmp_path)).collect()}
    assert {1, 2} <= ids and not {3, 4} & ids


def test_revisits_are_held_against_their_response(spark, tmp_path):
    body = "HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
    digest = hashlib.sha1(b"hello").hexdigest()

    def record(page, kind, to=None, named=digest, size=5):
        content = body if kind == "response" else f"HTTP/1.1 200 OK\r\nContent-Length: {size}\r\n\r\n"
        refers = f"WARC-Refers-To: <urn:page:{to}>\r\n" if to else ""
        return (f"{VERSION}WARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Payload-Digest: sha1:{named}\r\n{refers}"
                f"Content-Length: {len(content)}\r\n\r\n{content}\r\n\r\n")

    (tmp_path / "a.warc").write_text(record(9, "response") + record(1, "revisit", 9) + record(2, "revisit", 8) + record(3, "revisit", 9, "0" * 40)
                                     + record(4, "revisit", 9, size=6) + record(5, "revisit") + record(6, "response", named="1" * 40), newline="")
    (tmp_path / "b.warc").write_text(record(7, "revisit", 9) + record(8, "revisit", 6, "1" * 40), newline="")
    found = {r.page_id: r.digest_ok for r in read_archives(spark, str(tmp_path)).collect()}
    assert found == {9: True, 1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: True, 8: False}


def test_empty_pages(spark):
    assert round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
