import os
import zlib

import numpy as np
import pytest
from cases import arrow, awkward, documents, empty, sentence
from moorline.llm import language_id
from moorline.llm import toxicity as toxicity_module
from moorline.llm.toxicity import BUCKETS, SubwordModel, bags, fit, toxicity, train, without_toxic
from moorline.llm.words import slices

FOLDER = "/root/testdata/sf0.1"


def labelled():
    bad = ["stupidly", "stupids", "moronic", "morons"]
    texts = [sentence(i, 30 + i % 40) for i in range(300)]
    labels = np.array([i % 3 == 0 for i in range(300)]).astype(int)
    return [f"{t} {bad[i % 4]} {t[:40]}" if labels[i] else t for i, t in enumerate(texts)], labels


def test_unseen_misspellings_share_grams():
    texts, labels = labelled()
    model = train(arrow(texts), labels, 0.33)
    new = [f"{sentence(900, 30)} stupidest {sentence(901, 10)}", f"{sentence(900, 30)} {sentence(901, 10)}", "", None]
    scores = np.concatenate([model.scores(b) for b in bags(arrow(new))])
    assert scores[0] > scores[1] and scores[2] == scores[3] == pytest.approx(1 / (1 + np.exp(-model.bias)))


def test_one_label_only_gives_a_constant():
    model = train(arrow(["a b", "c"]), np.array([0, 0]), 0.0)
    assert not model.values.any() and train(arrow([]), np.array([]), 0.0).values.shape == (BUCKETS,)


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity(docs, fit(docs, labels)).join(labels, "doc_id").toPandas()
    own = found[found.held_out]
    assert len(own) > 500
    assert own.predicted[own.toxic == 1].mean() > 0.85
    assert own.predicted[own.toxic == 0].mean() < 0.1
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(found.doc_id, found.held_out))


def test_awkward_rows_score(spark):
    model = SubwordModel(np.zeros(BUCKETS), -1.0)
    found = toxicity(awkward(spark), model).collect()
    assert len(found) == awkward(spark).count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in found)
    assert toxicity(empty(spark), model).collect() == []
    assert without_toxic(awkward(spark), model).collect() == awkward(spark).collect()
    assert without_toxic(awkward(spark), SubwordModel(np.zeros(BUCKETS), 1.0)).collect() == []
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (13, 0)], "doc_id long, toxic int")
    assert toxicity(awkward(spark), fit(awkward(spark), labels)).count() == awkward(spark).count()
    assert fit(empty(spark), labels.limit(0)).bias < 0.1


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.language_id(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    own = found[found.held_out]
    assert (own.lang_pred == own.lang).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_bits_hold_every_gram_of_many_languages():
    texts = [sentence(i, 200) for i in range(70)]
    names = [f"l{i:02}" for i in range(70)]
    filters = language_id.LanguageFilters.fit(arrow(texts), arrow(names))
    assert filters.table.shape[1] == 2
    best = np.concatenate([filters.predict(p)[0] for p in slices(arrow(texts))])
    assert best.tolist() == list(range(70))


def test_awkward_rows_language(spark):
    docs = awkward(spark)
    found = language_id.language_id(docs, language_id.fit(docs)).collect()
    got = {r.doc_id: r.lang_pred for r in found}
    assert len(found) == docs.count()
    assert got[4] == got[5] == got[6] == got[12] == "und" and got[11] != "und" and got[1] in ("en", "de")
    assert language_id.language_id(empty(spark), language_id.fit(empty(spark))).collect() == []
    untaught = language_id.language_id(docs, language_id.fit(empty(spark))).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    assert documents(spark, []).count() == 0


def plain_grams(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalpha() else 32 for b in (text or "").encode())
    return [data[i:i + 4] for i in range(len(data) - 3) if 32 not in data[i + 1:i + 3]]


def test_language_scores_match_plain_sets():
    """Every n-gram of the sample counts, however rare, and a text's counts are set memberships."""
    texts = [sentence(i, 60) for i in range(12)] + ["Ölçü çığ größe", "日本語 の 文 日本語の文"]
    names = [("aa", "bb", "cc")[i % 3] for i in range(12)] + ["dd", "ee"]
    filters = language_id.LanguageFilters.fit(arrow(texts), arrow(names))
    known = {n: {g for t, own in zip(texts, names) if own == n for g in plain_grams(t)} for n in filters.languages}
    asked = [*texts, sentence(50, 80), sentence(1, 7) + " " + sentence(2, 9), "größe", "日本語", "12 .", "", None, "x" * 3]
    got = [np.concatenate(x) for x in zip(*(filters.predict(p) for p in slices(arrow(asked), 900)))]
    for text, best, score in zip(asked, *got):
        found = plain_grams(text)
        counts = [max((sum(g in known[n] for g in found) - len(found) * c) / (1 - c), 0) for n, c in zip(filters.languages, filters.chance)]
        if not any(c.isalpha() for c in text or ""):
            assert (best, score) == (-1, 0)
        elif sum(counts):
            assert best == counts.index(max(counts)) and score == pytest.approx(max(counts) / sum(counts))
        else:
            assert score == pytest.approx(1 / len(filters.languages))


def test_the_table_grows_with_the_ngrams():
    few, many = (language_id.LanguageFilters.fit(arrow([sentence(i, 300) for i in range(n)]), arrow(["aa"] * n)) for n in (2, 900))
    assert len(many.table) > len(few.table) and max(many.chance) < 0.02
    codes = np.concatenate([language_id.grams(p)[0] for p in slices(arrow([sentence(i, 300) for i in range(900)]))])
    log = len(many.table).bit_length() - 1
    assert all((many.table[many.rows(codes, k, log), 0] & np.uint64(1)).all() for k in range(language_id.HASHES))


def plain_score(model, text):
    """The score of one text by plain Python numbers."""
    base, most = 0x9E3779B97F4A7C15 | 1, 1 << 64

    def row(part):
        x = sum((b + 1) * pow(base, i, most) for i, b in enumerate(part)) % most
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ x >> 33) * factor % most
        return (x ^ x >> 33) % BUCKETS

    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in data).split()
    means = []
    for word in words:
        padded = b" " + word + b" "
        parts = [word, *(padded[i:i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1))]
        means.append(sum(model.values[row(p)] for p in parts) / len(parts))
    return 1 / (1 + np.exp(-((sum(means) / len(means) if means else 0) + model.bias)))


def test_toxicity_scores_match_plain_python():
    texts, labels = labelled()
    model = train(arrow(texts), labels, 0.33)
    asked = [*texts[:12], "MORONS! morons, moron-ic", "a", "é ñandú 你好", "", None, "... !!", "stupids " * 300]
    scores = np.concatenate([model.scores(b) for b in bags(arrow(asked), 400)])
    assert scores == pytest.approx([plain_score(model, t) for t in asked], abs=1e-9)


def test_toxicity_trains_in_a_task(spark, monkeypatch):
    """The driver has no memory to spare for it; the model that comes back is the trained one."""
    def trained(column, labels, share):
        values = np.zeros(toxicity_module.BUCKETS)
        values[[0, 5]] = len(column), labels.sum()
        return toxicity_module.SubwordModel(values, float(os.getpid()))

    monkeypatch.setattr(toxicity_module, "train", trained)
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(40)] + [(None, "no key"), (3, None)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1)], "doc_id LONG, toxic INT")
    taught = labels.where("doc_id IS NOT NULL AND pmod(crc32(CAST(doc_id AS STRING)), 4) <> 2")
    model = toxicity_module.fit(docs, labels)
    assert model.bias != os.getpid()
    assert np.flatnonzero(model.values).tolist() == [0, 5]
    assert (model.values[0], model.values[5]) == (taught.count(), taught.where("toxic = 1").count())
    assert toxicity_module.fit(docs.limit(0), labels.limit(0)).values.tolist() == [0.0] * BUCKETS
