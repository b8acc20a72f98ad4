"""Toxicity by subword-bag embeddings and a linear softmax (operator 3).

A word's vector is the mean of the vectors of its character n-grams and of itself, all found
by hash in one table; a text's vector is the mean of its words' vectors. The table and the
softmax over it are trained jointly in numpy in one task, on a bounded sample of labelled
rows. A misspelling that was never seen shares n-grams with words that were.

Averaging and the softmax are both linear, so scoring needs one number per table row: the
trained vectors are folded with the softmax, and a task looks up two megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.words import LOWER, PLAIN, SLICE_BYTES, prefix_hashes, range_hashes, slices, split_words

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
# The sample: at most so many rows of label 0 and 1, of texts of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = (3000, 1500), 1 << 15
# Bytes of the sample that training cuts into subwords at a time, which take a hundred times as much.
TRAINING_SLICE = 1 << 18
# A subword counts if its rates under the two labels differ by so many standard errors.
LEAST_APART = 5.0
# The clearest so many at most.
MOST_ROWS = 4096
DIMENSIONS, ROUNDS, RATE = 4, 50, 0.05
THRESHOLD = 0.3


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word's n-grams and of itself, and each word's bounds among them.

    ``data`` has a byte that is no word byte on both sides of each word; n-grams may take it
    in, so that the start and the end of a word count.
    """
    sums = prefix_hashes(data)
    owners, rows = [np.arange(len(starts), dtype=np.int32)], [range_hashes(sums, starts, ends)]
    for n in GRAMS:
        counts = np.maximum(ends - starts + 3 - n, 0)
        at = _ranges(starts - 1, counts)
        owners.append(np.repeat(owners[0], counts))
        rows.append(range_hashes(sums, at, at + n))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(rows)[order] % np.uint64(BUCKETS)).astype(np.int32), np.searchsorted(owner[order], np.arange(len(starts) + 1))


@dataclass
class Bags:
    """Texts as bags of distinct words, and the words as bags of subwords."""

    rows: np.ndarray      # subword table rows, word by word
    bounds: np.ndarray    # of words among them
    words: np.ndarray     # word numbers, text by text
    texts: np.ndarray     # bounds of texts among them


def bags(column: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[Bags]:
    """Bags of each slice of a string column."""
    for part in slices(column, most_bytes):
        words = split_words(part, PLAIN)
        _, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
        # Distinct words side by side, with a blank around each.
        low, high = words.starts[first], words.ends[first]
        sizes = high - low
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes
        data = np.full(int(ends[-1]) + 1 if len(ends) else 1, 0x20, np.uint8)
        data[_ranges(starts, sizes)] = LOWER[part.data[_ranges(low, sizes)]]
        rows, bounds = subwords(data, starts, ends)
        yield Bags(rows, bounds, number, words.bounds)


def means(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of the values in each range, 0 where it is empty."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    counts = np.maximum(np.diff(bounds), 1)
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / counts.reshape(-1, *[1] * (values.ndim - 1))


@dataclass
class SubwordModel:
    """One number per table row and a bias: the trained vectors folded with the softmax."""

    values: np.ndarray
    bias: float

    def scores(self, bag: Bags) -> np.ndarray:
        words = means(self.values[bag.rows], bag.bounds)
        return 1 / (1 + np.exp(-np.clip(means(words[bag.words], bag.texts) + self.bias, -40, 40)))


def _ranges(low: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers from each of ``low`` on, one range after the other."""
    return np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _words_of_texts(bag: Bags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, distinct word and its share of the text's words, for each pair that occurs."""
    text = np.repeat(np.arange(len(bag.texts) - 1), np.diff(bag.texts))
    words = len(bag.bounds) - 1
    pair, count = np.unique(text * words + bag.words, return_counts=True)
    text, word = pair // max(words, 1), pair % max(words, 1)
    return text, word, count / np.diff(bag.texts)[text]


def telling(column: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Table rows whose rates under the two labels differ clearly, and the usual subwords of a text."""
    seen, sizes, subwords_in_all, first = np.zeros((2, BUCKETS)), np.ones(2), 0, 0
    for bag in bags(column, TRAINING_SLICE):
        text, word, _ = _words_of_texts(bag)
        per_word = np.diff(bag.bounds)
        subwords_in_all += per_word[word].sum()
        for k in (0, 1):
            own = np.bincount(word[labels[first + text] == k], minlength=len(per_word))
            seen[k] += np.bincount(bag.rows, np.repeat(own, per_word), BUCKETS)
            sizes[k] += own.sum()
        first += len(bag.texts) - 1
    both = seen.sum(axis=0) / sizes.sum()
    spread = np.sqrt(both * (1 - both) * (1 / sizes).sum())
    apart = np.abs(seen[1] / sizes[1] - seen[0] / sizes[0]) / np.where(spread > 0, spread, 1)
    best = np.argsort(-apart, kind="stable")[:MOST_ROWS]
    return np.sort(best[apart[best] >= LEAST_APART]), subwords_in_all / max(len(labels), 1)


def inputs(column: pa.Array, chosen: np.ndarray) -> np.ndarray:
    """Weight of each chosen table row in each text's mean (texts x rows)."""
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    out = []
    for bag in bags(column, TRAINING_SLICE):
        text, word, value = _words_of_texts(bag)
        at = place[bag.rows]
        kept = np.concatenate([[0], np.cumsum(at >= 0)])[bag.bounds]
        counts = np.diff(kept)[word]
        take = np.flatnonzero(at >= 0)[_ranges(kept[:-1][word], counts)]
        weight = np.repeat(value / np.diff(bag.bounds)[word], counts)
        cell = np.repeat(text, counts) * len(chosen) + at[take]
        rows = len(bag.texts) - 1
        out.append(np.bincount(cell, weight, rows * len(chosen)).astype(np.float32).reshape(rows, len(chosen)))
    return np.concatenate(out)


def train(column: pa.Array, labels: np.ndarray, share: float, seed: int = 7) -> SubwordModel:
    """Vectors and softmax together, by Adam on the weighted log loss of all texts.

    Classes are weighted so that label 1 has the share ``share``, whatever the sample holds.
    Subwords that don't tell the labels apart keep the zero vector. Every fifth text only
    watches: the round with the least loss on those is kept.
    """
    n, ones = len(labels), labels.sum()
    constant = SubwordModel(np.zeros(BUCKETS), float(np.log((ones + 1) / (n - ones + 1))))
    if not 0 < ones < n:
        return constant
    chosen, usual = telling(column, labels)
    if not len(chosen):
        return constant
    share = min(max(share, 1e-4), 1 - 1e-4)
    weight = np.where(labels == 1, share / ones, (1 - share) / (n - ones))
    # Inputs are scaled so that a rare subword can act within the rounds there are.
    scale = np.float32(np.sqrt(usual))
    texts = inputs(column, chosen) * scale
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.1, (len(chosen), DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    params = [table, softmax, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    target = np.stack([labels == 0, labels == 1], axis=1).astype(np.float32)
    watching = np.arange(n) % 5 == 4
    best = (np.inf, *[p.copy() for p in params])
    for step in range(1, ROUNDS + 1):
        pooled = texts @ table
        logits = pooled @ softmax + bias
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        loss = -(weight * np.log(np.maximum((chance * target).sum(axis=1), 1e-12)))[watching].sum()
        if loss < best[0]:
            best = (loss, *[p.copy() for p in params])
        error = ((chance - target) * (weight * ~watching)[:, None]).astype(np.float32)
        for p, g, m, v in zip(params, [texts.T @ (error @ softmax.T), pooled.T @ error, error.sum(axis=0)], first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    _, table, softmax, bias = best
    values = np.zeros(BUCKETS)
    values[chosen] = scale * (table @ (softmax[:, 1] - softmax[:, 0]))
    return SubwordModel(values, float(bias[1] - bias[0]))


def held_out(key: str) -> F.Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> SubwordModel:
    """Train on a sample of the rows that are not held out, the same at every run.

    The sample has the ``SAMPLE_ROWS`` least hashes of each label; texts over ``SAMPLE_BYTES``
    bytes are passed over, whole texts of the others are used. Null labels and keys are no
    examples; a key with several labels is an example of each.
    """
    own = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    own = own.where(~held_out("id"))
    share = own.agg(F.avg("label")).first()[0] or 0.0
    order = [F.xxhash64("id"), "id"]
    zeros, ones = (own.where(F.col("label") == k).orderBy(*order).limit(SAMPLE_ROWS[k]) for k in (0, 1))
    # At most the sum of SAMPLE_ROWS keys are sent, whatever the tables hold.
    found = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    rows = found.join(F.broadcast(zeros.union(ones).distinct()), "id").orderBy(*order, "label", "text").limit(sum(SAMPLE_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [*batches]
        column = pa.concat_arrays([part.column(0) for part in parts] or [pa.array([], pa.string())])
        model = train(column, np.concatenate([np.asarray(part.column(1)) for part in parts] or [np.zeros(0, int)]), share)
        told = np.flatnonzero(model.values)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(told, -1)), pa.array(np.append(model.values[told], model.bias))], ["row", "value"])

    # A task trains, as it has the memory; what comes back is a number for each telling row, and the bias.
    trained = rows.select("text", "label").coalesce(1).mapInArrow(run, "row long, value double").toArrow()
    values, at = np.zeros(BUCKETS + 1), np.asarray(trained["row"])
    values[at] = np.asarray(trained["value"])
    return SubwordModel(values[:-1], float(values[-1]))


def toxicity(docs: DataFrame, model: SubwordModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(key, held_out, score, predicted)``.

    ``score`` is the model's chance of label 1 for the whole text; a null, empty or wordless text
    gets the bias alone. ``predicted`` is 1 from ``THRESHOLD`` on. ``held_out`` marks keys whose
    labels training never sees; it is false for a null key. Other columns are not read.
    """
    spread = docs.sparkSession.sparkContext.broadcast((model.values, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SubwordModel(*spread.value)
        for batch in batches:
            scores = [model.scores(bag) for bag in bags(batch.column(1))]
            if scores:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], [key, "score"])

    rows = docs.select(F.col(key), F.col(text).cast("string"))
    scored = rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, score double")
    return scored.select(
        key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: SubwordModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``THRESHOLD``, as they are; nothing is shuffled."""
    spread = docs.sparkSession.sparkContext.broadcast((model.values, model.bias))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SubwordModel(*spread.value)
        for batch in batches:
            scores = [model.scores(bag) for bag in bags(batch.column(names.index(text)))]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
