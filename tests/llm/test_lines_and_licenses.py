import oracle
import pytest
from cases import awkward, awkward_rows, documents, empty, sentence
from moorline.llm import license_scan as licenses
from moorline.llm.license_scan import license_scan, notices
from moorline.llm.line_dedup import spread_dedup
from moorline.llm.queries import ORACLES, QUERIES


def brute_lines(rows, least):
    strip = lambda line: line.strip(" \t\r")
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            if strip(line):
                sites.setdefault(strip(line), set()).update([site] if site is not None else [])
                if i is not None:
                    first[strip(line)] = min(i, first.get(strip(line), i))
    out = []
    for i, text, _ in rows:
        if text is None or i is None:
            out.append((i, text, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not strip(x) or len(sites[strip(x)]) < least or first[strip(x)] == i]
        out.append((i, "\n".join(kept), len(lines) - len(kept)))
    return out


def test_spread_lines_match_brute_force(spark):
    common, rare = "Accept all cookies", "seen on few sites"
    rows = [(i, f"{sentence(i, 9)}\n {common}\t\n\n{rare if i < 9 else 'x'}\n{common}", f"s{i % 14}") for i in range(60)]
    rows += [(r[0] + 100 if r[0] else None, r[1], r[3]) for r in awkward_rows()] + [(None, common, "s99"), (500, common, None)]
    for least in (3, 9, 10):
        found = [(r.doc_id, r.text, r.n_removed) for r in spread_dedup(documents(spark, rows), least).collect()]
        assert sorted(found, key=str) == sorted(brute_lines(rows, least), key=str)


def test_lines_of_awkward_rows(spark):
    found = spread_dedup(awkward(spark), 2)
    assert set(found.columns) == set(awkward(spark).columns)
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(
        (x[:2] for x in brute_lines([(r[0], r[1], r[3]) for r in awkward_rows()], 2)), key=str
    )
    assert spread_dedup(empty(spark)).collect() == []


def brute_licenses(rows, templates, num=19, den=20):
    import re

    split = lambda t: [w for w in re.split(r"[^a-z0-9\x80-\U0010FFFF]+", (t or "").lower()) if w]
    grams = lambda w: [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    known = {n: grams(split(t)) for n, t in templates}
    stride = max((len(g) + 2 for g in known.values() if g), default=3)
    out = set()
    for i, text in rows:
        at = grams(split(text))
        for name, own in known.items():
            best = 0
            for start in range(-stride, len(at) + 1, stride):
                best = max(best, len(set(at[max(start, 0):start + 2 * stride]) & set(own)))
            if i is not None and own and best * den >= len(set(own)) * num:
                out.add((i, name, best, len(set(own))))
    return out


def test_licenses_match_brute_force(spark):
    text = dict(licenses.NOTICES)
    rows = [
        (1, sentence(1) + "\n" + text["MIT"]), (2, text["Apache-2.0"].upper() + " " + text["GPL-3.0"]), (3, text["BSD-3-Clause"].replace(" ", "  *\n ")),
        (4, "released under the mit"), (5, text["GPL-3.0"].replace("version 3", "version 9")), (6, (sentence(2, 500) + " " + text["ISC"] + " ") * 3), (7, "é" + text["MIT"]),
        (2, text["MIT"]), (None, text["MIT"]), (8, " ".join(text.values())),
    ] + [(100 + (r[0] or 0), r[1]) for r in awkward_rows()]
    found = license_scan(documents(spark, [(i, t, "s") for i, t in rows]), notices(spark)).collect()
    merged = {}
    for i, t in rows:
        for x in brute_licenses([(i, t)], licenses.NOTICES):
            merged[x[:2]] = max(x, merged.get(x[:2], x))
    assert {(r.doc_id, r.license_id, r.shared, r.n_shingles) for r in found} == set(merged.values()) and len(found) == len(merged)


def test_short_notices_beside_other_known_text(spark):
    short, long = "released under the moor license", sentence(3, 3000)
    templates = spark.createDataFrame([("short", short), ("long", long)], "license_id string, text string")
    # Each text has a short notice amid words of the long template; the last has its words far apart.
    words = long.split()
    rows = [(i, " ".join([*words[40 * i:40 * i + 1400], short, *words[40 * i + 1400:40 * i + 2800]]), "s") for i in range(30)]
    rows.append((99, "released under the moor " + " ".join(words[:300]) + " the moor license", "s"))
    found = license_scan(documents(spark, rows), templates).where("license_id = 'short'").collect()
    assert {(r.doc_id, r.shared, r.first_word) for r in found} == {(i, 3, 1400) for i in range(30)}


def test_query_finds_licence_texts_headers_and_identifiers(spark, tmp_path):
    text = {r.license_id: r.text for r in licenses.license_texts(spark).collect()}
    rows = [
        (1, text["MIT/text"].replace("merge", "mix")), (2, "# " + text["GPL-3.0/header"].replace(" ", "\n# ")), (3, sentence(4, 900) + text["GPL-2.0/text"] + sentence(5, 900)),
        (4, "// SPDX-License-Identifier: LGPL-2.1-or-later"), (5, text["BSD-2-Clause/text"]), (6, text["GPL-3.0/text"]), (7, sentence(6, 3000)),
    ]
    documents(spark, [(i, t, "s") for i, t in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op9_license_scan"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.license_id) for r in found} == {
        (1, "MIT/text"), (2, "GPL-3.0/header"), (3, "GPL-2.0/text"), (4, "LGPL-2.1/spdx"), (5, "BSD-2-Clause/text"), (5, "BSD-3-Clause"), (6, "GPL-3.0/text"),
    }
    sizes = [len(split) for split in (t.replace("-", " ").replace(".", " ").split() for n, t in text.items() if n.endswith("/spdx"))]
    assert max(sizes) <= max(len(t.split()) for _, t in licenses.NOTICES)


def test_licenses_of_awkward_rows(spark):
    assert license_scan(awkward(spark), notices(spark)).collect() == []
    assert license_scan(empty(spark), notices(spark)).collect() == []
    assert license_scan(awkward(spark), notices(spark).limit(0)).collect() == []


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    oracle.compare(QUERIES[name](spark, folder), oracle.connect(folder), ORACLES[name])
