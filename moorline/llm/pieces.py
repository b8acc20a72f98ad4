"""Sentence-piece encoding and decoding with the tokenizers library (operator 6).

The model file is parsed here and rebuilt in the library: its normaliser, the marker for blanks,
unigram scores or merges in the order of their scores, and byte fallback. A sample of texts must
get the same numbers as from the library that the model comes from, or nothing runs.

No piece has a marker after another character, so a text falls into chunks, each from a run of
blanks to before the next, that are encoded on their own. A task encodes each distinct chunk of
its texts once, many at a time in the library's own threads, and puts the texts together from
their chunks; every distinct chunk is decoded again to check the round trip.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.piece_model import BPE, MARKER, PieceModel, read_model
from moorline.llm.words import Slice, prefix_hashes, range_hashes, slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
PARITY_ROWS, PARITY_BYTES = 200, 1 << 14
# Threads of the library in each Python worker, and chunks that it gets at a time.
THREADS, AT_A_TIME = 2, 8192


def build(model: PieceModel, whole: bool = True):
    """The model as a tokenizer; without ``whole`` one for chunks, that adds no blank in front."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if not model.escape_spaces:
        raise ValueError("models that keep blanks as they are aren't supported")
    usable = model.usable()
    if model.kind == BPE:
        known = {model.pieces[i]: i for i in usable}
        ranked = []
        for text, number in known.items():
            for cut in range(1, len(text)):
                left, right = known.get(text[:cut]), known.get(text[cut:])
                if left is not None and right is not None:
                    ranked.append((-model.scores[number], left, right, text[:cut], text[cut:]))
        merges = [(left, right) for *_, left, right in sorted(ranked)]
        vocabulary = {text: i for i, text in enumerate(model.pieces)}
        backend = models.BPE(vocabulary, merges, unk_token=model.pieces[model.unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        backend = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(backend)
    steps = []
    if whole:
        if model.charsmap:
            steps.append(normalizers.Precompiled(model.charsmap))
        if model.extra_spaces_go:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(MARKER))
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARKER}*[^{MARKER}]+|{MARKER}+"), "isolated")
    steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    parts = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if whole and model.dummy_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


def check_chunks(model: PieceModel) -> None:
    """Chunks are encoded alone only if no piece reaches over their border."""
    if any(MARKER in model.pieces[i].lstrip(MARKER) for i in model.usable()):
        raise ValueError("a piece of this model has a blank inside, so texts can't be cut at blanks")
    if model.charsmap or model.extra_spaces_go or not model.dummy_prefix:
        raise ValueError("this model changes texts before it cuts them; encode them whole")


def parity(tokenizer, path: str, texts: list[str]) -> None:
    """Raise unless the source library encodes and decodes every text alike."""
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=path)
    ours = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, ours):
        if theirs.encode(text) != ids:
            raise ValueError(f"encoding differs for {text[:80]!r}")
        if theirs.decode(ids) != tokenizer.decode(ids, skip_special_tokens=False):
            raise ValueError(f"decoding differs for {text[:80]!r}")


def _backend(data: bytes):
    """The tokenizer of a worker process, built once and kept for its later tasks.

    Functions come to a worker by value with each task, so what is kept hangs on the library.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    import tokenizers

    kept = vars(tokenizers).setdefault("_kept_by_moorline", {})
    if hash(data) not in kept:
        kept.clear()
        kept[hash(data)] = tokenizers.Tokenizer.from_str(data.decode())
    return kept[hash(data)]


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks of all texts, and each text's bounds among them."""
    blank = data == 0x20
    first = np.zeros(len(data) + 1, bool)
    first[1:-1] = blank[1:] & ~blank[:-1]
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(first[:-1])
    return starts, np.searchsorted(starts, offsets)


class Chunks:
    """Numbers of the distinct chunks that a task has met, by hash; emptied when they are many."""

    MOST = 1 << 20

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.clear()

    def clear(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.numbers, self.bounds, self.same = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)

    def slots_of(self, keys: np.ndarray, text) -> np.ndarray:
        """Where each of the distinct ascending ``keys`` is; ``text(i)`` gives the chunk of a new one."""
        if len(self.keys) > self.MOST:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        held = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        held[inside] = self.keys[at[inside]] == keys[inside]
        slots = np.empty(len(keys), np.int64)
        slots[held] = self.slots[at[held]]
        new = np.flatnonzero(~held)
        slots[new] = len(self.same) + np.arange(len(new))
        numbers, counts, same = [self.numbers], [], [self.same]
        for low in range(0, len(new), AT_A_TIME):
            chunks = [text(i) for i in new[low:low + AT_A_TIME]]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            numbers.append(np.fromiter(chain.from_iterable(ids), np.int32, int(counts[-1].sum())))
            same.append(np.fromiter((a == b for a, b in zip(chunks, back)), bool, len(chunks)))
        if counts:
            self.numbers, self.same = np.concatenate(numbers), np.concatenate(same)
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(counts))])
            self.keys, self.slots = np.insert(self.keys, at[new], keys[new]), np.insert(self.slots, at[new], slots[new])
        return slots


def encoded(part: Slice, known: Chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all texts of a slice, each text's bounds among them, and its round trip."""
    data, offsets = part.data, part.offsets
    raw = data.tobytes()
    if MARKER.encode() in raw:
        texts = [raw[a:b].replace(MARKER.encode(), b" ") for a, b in zip(offsets[:-1], offsets[1:])]
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts, bounds = chunk_bounds(data, offsets)
    ends = np.append(starts[1:], len(data))
    leads = np.zeros(len(starts), bool)
    leads[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    # A text starts with a blank of its own, so its first chunk is another one.
    keys, first, number = np.unique(
        range_hashes(prefix_hashes(data), starts, ends) ^ leads.astype(np.uint64), return_index=True, return_inverse=True
    )
    slots = known.slots_of(keys, lambda i: (" " if leads[first[i]] else "") + raw[starts[first[i]]:ends[first[i]]].decode("utf-8", "replace"))[number]
    low, sizes = known.bounds[slots], known.bounds[slots + 1] - known.bounds[slots]
    numbers = known.numbers[np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    totals = np.concatenate([[0], np.cumsum(sizes)])
    wrong = np.concatenate([[0], np.cumsum(~known.same[slots])])
    return numbers, totals[bounds], wrong[bounds[1:]] == wrong[bounds[:-1]]


def encode(docs: DataFrame, path: str = MODEL_PATH, text: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` without its text column, with ``token_ids, n_tokens, round_trip``.

    With ``digest``, ``ids_sha256`` over the numbers as four little-endian bytes each stands for
    ``token_ids``. An empty text has no tokens and a null one neither; its ``token_ids`` are
    empty. ``round_trip`` says that decoding gives the text again, with every marker character
    as a blank. Own columns win over columns of ``docs`` with the same name. The model file is
    read on the driver alone; a sample of ``PARITY_ROWS`` texts of up to ``PARITY_BYTES`` bytes
    is compared with the library the model comes from.
    """
    spark = docs.sparkSession
    model = read_model(path)
    check_chunks(model)
    sample = docs.select(F.col(text).cast("string").alias("text")).where(F.octet_length("text").between(1, PARITY_BYTES))
    parity(build(model), path, [row[0] for row in sample.orderBy(F.xxhash64("text")).limit(PARITY_ROWS).collect()])
    data = spark.sparkContext.broadcast(build(model, whole=False).to_str().encode())
    own = ["ids_sha256" if digest else "token_ids", "n_tokens", "round_trip"]
    others = [c for c in docs.columns if c not in {text, *own}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Chunks(_backend(data.value))
        for batch in batches:
            for part in slices(batch.column(0)):
                numbers, bounds, same = encoded(part, known)
                if digest:
                    blobs = numbers.astype("<i4").tobytes()
                    ids = pa.array([hashlib.sha256(blobs[4 * a:4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])], pa.string())
                else:
                    ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(numbers, pa.int32()))
                rest = [batch.column(i + 1).slice(part.first, part.rows) for i in range(len(others))]
                yield pa.RecordBatch.from_arrays(
                    [*rest, ids, pa.array(np.diff(bounds)), pa.array(same)], [*others, *own]
                )

    rows = docs.select(F.col(f"`{text}`").cast("string"), *[F.col(f"`{c}`") for c in others])
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), f"{own[0]} {'string' if digest else 'array<int>'}, n_tokens long, round_trip boolean"])
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str = MODEL_PATH, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """``tokens`` with its column of token numbers turned back into ``text``; null stays null."""
    data = tokens.sparkSession.sparkContext.broadcast(build(read_model(path)).to_str().encode())

    @F.pandas_udf("string")
    def run(column):
        tokenizer = _backend(data.value)
        texts = tokenizer.decode_batch([[] if x is None else list(x) for x in column], skip_special_tokens=False)
        return column.__class__([None if x is None else t for x, t in zip(column, texts)], dtype=object)

    others = [c for c in tokens.columns if c not in (ids, text)]
    return tokens.select(*[F.col(f"`{c}`") for c in others], run(F.col(ids)).alias(text))
