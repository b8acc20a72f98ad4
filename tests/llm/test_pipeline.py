import corpus_pipeline
import pytest
from cases import awkward, awkward_rows, documents, empty, sentence
from test_decontamination import words
from test_lines_and_licenses import brute_lines
from moorline.llm.line_dedup import passage_dedup
from moorline.llm.toxicity import fit
from moorline.llm.toxicity import toxicity as score
from test_near_duplicates import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns_and_whole_inputs(stages):
    for before, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert set(texts(after)) <= set(texts(before))


def test_toxicity_keeps_clean_documents(spark, stages):
    before, after = stages[0]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = set(texts(before)) - set(texts(after))
    clean = [i for i, t in labels.items() if t == 0 and i in texts(before)]
    assert len(gone & set(clean)) <= 0.1 * len(clean)


def test_toxicity_drops_exactly_what_scores_high(spark, stages):
    before, after = stages[0]
    model = fit(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r.doc_id: r.score for r in score(before, model).collect()}
    gone = set(texts(before)) - set(texts(after))
    assert gone and gone == {i for i, x in scores.items() if x >= 0.3}
    assert texts(after) == {i: t for i, t in texts(before).items() if scores[i] < 0.3}


def test_each_stage_takes_effect(stages):
    """A stage that passes its input on would fail here."""
    for before, after in stages[:4]:
        assert texts(before) != texts(after)


def test_line_dedup_matches_brute_force(stages):
    before, after = stages[1]
    want = {i: t for i, t, n in brute_lines([(r.doc_id, r.text, r.source) for r in before.collect()], 10) if not (n and not t.strip(" \t\r\n"))}
    assert texts(after) == want


def plain_passages(rows, words=50):
    """Texts without repeated lines of more than ``words`` words, but in the row with the least key."""
    strip = lambda line: line.strip(" \t\r")
    long = lambda line: len(line.split()) > words
    holders = {}
    for i, text in rows:
        for line in set(map(strip, (text or "").split("\n"))):
            if i is not None and long(line):
                holders.setdefault(line, set()).add(i)
    out = []
    for i, text in rows:
        if text is None or i is None:
            out.append((i, text))
            continue
        kept = [x for x in text.split("\n") if not long(strip(x)) or len(holders[strip(x)]) < 2 or min(holders[strip(x)]) == i]
        out.append((i, "\n".join(kept)))
    return out


def test_near_dedup_matches_brute_force(stages):
    """The documents that stay, and their texts after the cut of passages that they still share."""
    before, after = stages[2]
    rows = list(texts(before).items())
    kept = [(i, dict(rows)[i]) for i, c in brute(rows, 80, 100).items() if i == c]
    want = {i: t for i, t in plain_passages(kept) if t == dict(rows)[i] or (t or "").strip(" \t\r\n")}
    assert texts(after) == want


def test_passages_match_plain_python(spark):
    passage, other = sentence(70, 51), sentence(71, 90)
    rows = [(i, f"{sentence(80 + i, 60)}\n\t{passage} \n{sentence(72, 50)}") for i in range(5)] + [(0, passage), (7, f"{other}\n{other}"), (8, other)]
    rows += [(9, None), (10, ""), (None, passage), (11, f"{passage}\r\n\n{passage}"), (12, passage.upper()), (13, other + " more")]
    found = passage_dedup(documents(spark, [(i, t, None) for i, t in rows]))
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(plain_passages(rows), key=str)
    assert passage_dedup(empty(spark)).collect() == []


def test_decontamination_leaves_no_window(spark, stages):
    before, after = stages[3]
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(len(w) - 9)}
    hit = lambda t: any(tuple(words(t)[k:k + 10]) in windows for k in range(len(words(t)) - 9))
    old, new = texts(before), texts(after)
    assert set(old) == set(new)
    assert all(new[i] == t if not hit(t) else new[i] != t for i, t in old.items())


def test_pieces_and_run(spark, stages):
    last = stages[4][1]
    assert last.where("NOT round_trip").count() == 0 and last.count() == stages[3][1].count()
    assert corpus_pipeline.run(spark, FOLDER).count() == last.count()


@pytest.mark.parametrize("number", range(5))
def test_awkward_rows_pass_every_stage(spark, number):
    stage = corpus_pipeline.STAGES[number][1]
    kept = stage(spark, awkward(spark), FOLDER)
    assert 0 < kept.count() <= len(awkward_rows())
    if number < 4:
        assert kept.columns == awkward(spark).columns
    assert stage(spark, empty(spark), FOLDER).count() == 0


def test_repeats_and_copies(spark):
    rows = [(i, sentence(7, 80), f"s{i % 3}") for i in (5, 3, 9)] + [(11, sentence(8, 80), "s1")]
    kept = corpus_pipeline.near_dedup(spark, documents(spark, rows), FOLDER)
    assert sorted(texts(kept)) == [3, 11]


def test_long_passages_on_few_sites_stay_once(spark):
    passage, line = sentence(20, 60), sentence(21, 50)
    rows = [(i, f"{sentence(30 + i, 300)}\n {passage}\n{line}\n{sentence(60 + i, 300)}", "s1" if i < 8 else "s2") for i in range(12)]
    kept = texts(corpus_pipeline.near_dedup(spark, documents(spark, rows), FOLDER))
    assert kept == {i: t if i == 0 else t.replace(f" {passage}\n", "") for i, t, _ in rows}
