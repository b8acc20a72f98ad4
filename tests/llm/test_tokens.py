import hashlib

import numpy as np
import pytest
import sentencepiece
from cases import arrow, awkward, awkward_rows, empty
from moorline.llm.longest_match import Automaton, token_counts
from moorline.llm.piece_model import MARKER, UNIGRAM, PieceModel, read_model
from moorline.llm.pieces import MODEL_PATH, build, decode, encode, parity
from moorline.llm.words import SPACED, slices, split_words


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)


def test_encoding_equals_the_source_library(spark, theirs):
    rows = [(r[0], r[1]) for r in awkward_rows()] + [(90, "  two  blanks \n\n x "), (91, "▁marker▁ ▁"), (92, "<s> <0x0A> <unk>"), (93, "aaaa" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = encode(docs)
    assert found.columns == ["doc_id", "token_ids", "n_tokens", "round_trip"]
    want = sorted(str((i, theirs.encode(t or ""))) for i, t in rows)
    got = found.collect()
    assert sorted(str((r.doc_id, list(r.token_ids))) for r in got) == want
    assert all(r.n_tokens == len(r.token_ids) and r.round_trip for r in got)
    back = {r.doc_id: r.text for r in decode(found).collect()}
    assert all(back[i] == (t or "").replace(MARKER, " ") for i, t in rows if i and i != 13)
    digests = {r.doc_id: r.ids_sha256 for r in encode(docs, digest=True).collect()}
    assert digests[93] == hashlib.sha256(np.array(theirs.encode("aaaa" * 50), "<i4").tobytes()).hexdigest()


def test_awkward_rows_keep_their_columns(spark):
    found = encode(awkward(spark).withColumnRenamed("key", "n_tokens"))
    assert found.count() == len(awkward_rows()) and found.columns[-3:] == ["token_ids", "n_tokens", "round_trip"]
    assert encode(empty(spark)).collect() == []


def test_parity_is_enforced():
    wrong = read_model(MODEL_PATH)
    wrong.scores = wrong.scores[::-1]
    with pytest.raises(ValueError, match="differs"):
        parity(build(wrong), MODEL_PATH, ["some ordinary words that merge"])


def test_decode_takes_nulls(spark):
    tokens = spark.createDataFrame([(1, None), (2, []), (3, [7, 9])], "doc_id long, token_ids array<int>")
    back = {r.doc_id: r.text for r in decode(tokens).collect()}
    assert back[1] is None and back[2] == "" and back[3]


def test_unigram_models_use_their_scores():
    model = PieceModel(["<unk>", "▁", "a", "b", "ab", "▁a"], [0, -3, -4, -4, -2, -2.5], [2, 1, 1, 1, 1, 1], UNIGRAM)
    assert build(model).encode(" ab ").ids == [1, 4]


def greedy(word, vocabulary, longest):
    rest, count = MARKER + word, 0
    while rest:
        size = next((n for n in range(min(longest, len(rest)), 0, -1) if rest[:n] in vocabulary), 0)
        if not size:
            return None
        rest, count = rest[size:], count + 1
    return count


def brute(text, vocabulary):
    longest = max(map(len, vocabulary))
    found = [greedy(w, vocabulary, longest) for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]
    return len(found), sum(1 if f is None else f for f in found), sum(f is None for f in found)


def test_counts_match_greedy_pieces(spark):
    model = read_model(MODEL_PATH)
    vocabulary = {model.pieces[i] for i in model.usable()}
    got = sorted(map(str, (tuple(r) for r in token_counts(awkward(spark)).collect())))
    assert got == sorted(str((r[0], *brute(r[1], vocabulary))) for r in awkward_rows())
    assert token_counts(empty(spark)).collect() == []


def test_failure_links_pop_several_pieces():
    vocabulary = {MARKER, "a", "b", "ab", "abcd", "bcx", "c", "abcdab", MARKER + "a", "é"}
    automaton = Automaton.of([p.encode() for p in sorted(vocabulary)])
    words = ["a", "abc", "abcda", "abcdabc", "abcx", "bcx", "d", "aé", "éb", "ababababc", "abcdabcdabcd"] * 3
    for part in slices(arrow([" ".join(words)])):
        split = split_words(part, SPACED, lower=False)
        counts = automaton.count(part.data, split.starts, split.ends).tolist()
    assert counts == [-1 if (g := greedy(w, vocabulary, 6)) is None else g for w in words]
