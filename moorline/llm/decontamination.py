"""Benchmark decontamination by an FM-index per shard of training text (operator 8).

The benchmark becomes phrases: its windows of consecutive words. It travels to the tasks in
blocks of bounded size, one pass over the documents per block. A task indexes its texts shard
by shard, searches all phrases of the block backwards through the index, locates what it finds
and merges the hits of a document into spans. No row leaves its task, so there is no shuffle
and a passage that a third of all documents share costs no more than any other.

A shard's index holds each maximal run of words that the block knows, if it is long enough for
a phrase; no phrase can touch anything else.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.fm_index import FmIndex
from moorline.llm.words import PLAIN, Slice, Words, mix, slices, split_words

BLOCK_BYTES = 4 << 20
SHARD_WORDS = 1 << 19
FOUND = "array<struct<first: long, last: long, start: long, stop: long>>"
FOUND_ARROW = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "stop")]))


def phrases(items: pa.Table, width: int) -> dict:
    """Distinct windows of a block of benchmark items, as ranges of known word numbers."""
    hashes, owners, starts, lengths = [], [], [], []
    names, base = [], 0
    for chunk, ids in zip(items["text"].chunks, items["item"].chunks):
        for part in slices(chunk):
            words = split_words(part, PLAIN)
            for row in range(part.rows):
                low, high = words.bounds[row], words.bounds[row + 1]
                if low == high:
                    continue
                count = max(1, high - low - width + 1)
                hashes.append(words.hashes[low:high])
                starts.append(base + np.arange(count))
                lengths.append(np.full(count, min(width, high - low)))
                owners.append(np.full(count, len(names)))
                names.append(str(ids[part.first + row].as_py()))
                base += high - low
    if not names:
        return {}
    hashes, owners, starts, lengths = (np.concatenate(x) for x in (hashes, owners, starts, lengths))
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    numbers = numbers.astype(np.int64) + 1
    key = lengths.astype(np.uint64)
    for step in range(width):
        more = np.flatnonzero(lengths > step)
        key[more] = mix(key[more] ^ hashes[starts[more] + step])
    _, first, phrase = np.unique(key, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([phrase, owners], axis=1), axis=0)
    return {
        "vocabulary": vocabulary, "numbers": numbers, "starts": starts[first], "lengths": lengths[first], "names": names,
        "owners": pairs[:, 1], "owned": np.searchsorted(pairs[:, 0], np.arange(len(first) + 1)),
    }


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    counts = high - low
    return np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


class Shard:
    """Runs of known words of many texts, until they are enough for an index."""

    def __init__(self, block: dict):
        self.block = block
        self.least = int(block["lengths"].min(initial=1 << 30))
        self.clear()

    def clear(self):
        self.pieces, self.size = [], 0

    def add(self, part: Slice, words: Words) -> None:
        """Take the runs of known words of a slice."""
        vocabulary = self.block["vocabulary"]
        number = np.searchsorted(vocabulary, words.hashes)
        number[number == len(vocabulary)] = 0
        known = vocabulary[number] == words.hashes
        before, after = np.concatenate(([False], known))[:-1], np.concatenate((known, [False]))[1:]
        edges = words.bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(known))]
        before[edges] = False
        after[edges - 1] = False
        low, high = np.flatnonzero(known & ~before), np.flatnonzero(known & ~after) + 1
        long = high - low >= self.least
        low, high = low[long], high[long]
        if not len(low):
            return
        taken = _ranges(low, high)
        text, offsets = words.rows()[taken], part.offsets
        place = np.arange(len(taken)) + np.repeat(np.arange(len(low)), high - low)
        total = len(taken) + len(low)

        def spread(values):
            out = np.zeros(total, np.int64)
            out[place] = values
            return out

        self.pieces.append((
            spread(number[taken] + 1), spread(text + part.first), spread(taken - words.bounds[text]),
            spread(words.starts[taken] - offsets[text]), spread(words.ends[taken] - offsets[text]),
        ))
        self.size += len(taken)

    def search(self) -> tuple[list, list]:
        """Spans ``(row, first, last, start, stop)`` and ``(row, item)`` pairs of all hits, then empty."""
        if not self.size:
            self.clear()
            return [], []
        symbol, row, word, start, stop = (np.concatenate(x) for x in zip(*self.pieces))
        self.clear()
        block = self.block
        index = FmIndex(symbol, len(block["vocabulary"]) + 1)
        low, high = index.search(block["numbers"], block["starts"], block["lengths"])
        high = np.maximum(low, high)
        if not (high > low).any():
            return [], []
        phrase = np.repeat(np.arange(len(low)), high - low)
        at = index.locate(_ranges(low, high))
        cover = np.zeros(len(symbol) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + block["lengths"][phrase], -1)
        hit = np.cumsum(cover)[:-1] > 0
        left = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1])))
        right = np.flatnonzero(hit & ~np.concatenate((hit[1:], [False])))
        spans = list(zip(row[left].tolist(), word[left].tolist(), (word[right] + 1).tolist(), start[left].tolist(), stop[right].tolist()))
        seen = np.unique(row[at] * len(low) + phrase)
        rows, phrase = seen // len(low), seen % len(low)
        owned = block["owned"]
        items = block["owners"][_ranges(owned[phrase], owned[phrase + 1])]
        rows = np.repeat(rows, owned[phrase + 1] - owned[phrase])
        return spans, [(r, block["names"][i]) for r, i in np.unique(np.stack([rows, items], axis=1), axis=0).tolist()]


def _merged(spans: list) -> list:
    """Spans of one text in order, those that touch or overlap joined."""
    out: list = []
    for first, last, start, stop in sorted(spans):
        if out and first <= out[-1][1]:
            if last > out[-1][1]:
                out[-1] = (out[-1][0], last, out[-1][2], stop)
        else:
            out.append((first, last, start, stop))
    return out


def _pass(block: Broadcast, text: str, finish: Callable | None):
    """One pass over batches of ``(row, n_words, found, items)`` for one block of phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = Shard(block.value)
            column = batch.column("row").field(text)
            counts = np.zeros(len(batch), np.int64)
            spans: dict[int, list] = {}
            items: dict[int, set] = {}

            def take():
                found, owners = shard.search()
                for row, *span in found:
                    spans.setdefault(row, []).append(tuple(span))
                for row, item in owners:
                    items.setdefault(row, set()).add(item)

            for part in slices(column):
                words = split_words(part, PLAIN)
                counts[part.first:part.first + part.rows] = np.diff(words.bounds)
                shard.add(part, words)
                if shard.size >= SHARD_WORDS:
                    take()
            take()
            for row, (old, names) in enumerate(zip(batch.column("found"), batch.column("items"))):
                if old.is_valid and len(old):
                    spans.setdefault(row, []).extend(tuple(s.values()) for s in old.as_py())
                    items.setdefault(row, set()).update(names.as_py())
            found = [_merged(spans.get(row, [])) for row in range(len(batch))]
            names = [sorted(items.get(row, ())) for row in range(len(batch))]
            if finish:
                yield finish(batch.column("row"), counts, found, names)
            else:
                rows = [[dict(zip(("first", "last", "start", "stop"), s)) for s in spans] for spans in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(rows, FOUND_ARROW), pa.array(names, pa.list_(pa.string()))],
                    ["row", "found", "items"],
                )

    return run


def _searched(rows: DataFrame, benchmark: DataFrame, text: str, item: str, width: int, finish: Callable, schema: str) -> DataFrame:
    """``rows`` (one struct column ``row``) through all blocks of the benchmark."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    rows = rows.select("row", F.lit(None).cast(FOUND).alias("found"), F.lit(None).cast("array<string>").alias("items"))
    kept = f"row {rows.schema['row'].dataType.simpleString()}, found {FOUND}, items array<string>"
    empty = {"vocabulary": np.zeros(1, np.uint64), "numbers": np.zeros(0, np.int64), "starts": np.zeros(0, np.int64),
             "lengths": np.zeros(0, np.int64), "names": [], "owners": np.zeros(0, np.int64), "owned": np.zeros(1, np.int64)}
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        block = rows.sparkSession.sparkContext.broadcast(phrases(own.toArrow(), width) or empty)
        last = k == blocks - 1
        rows = rows.mapInArrow(_pass(block, text, finish if last else None), schema if last else kept)
    return rows


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """One row per row of ``docs``: ``(key, n_words, n_hit, n_items, items_sha256, contaminated, spans)``.

    A-Z are lower-cased; words are runs of letters, digits and other alphabets. A window is
    ``width`` consecutive words of an item; an item of fewer words is one window, an item
    without words none. A word of a document inside any window that occurs there is hit.
    ``n_items`` counts the items with such windows; an item id that repeats is one item, a null
    id is the item ``None``. ``items_sha256`` hashes their ids, sorted as strings and joined by
    commas. ``spans`` has the hit byte ranges, merged. A null or empty text has no words. Rows
    that repeat stay; keys and other columns are not looked at.
    """

    def report(row, counts, found, names):
        hits = [sum(last - first for first, last, _, _ in spans) for spans in found]
        spans = [[{"start": start, "stop": stop} for _, _, start, stop in s] for s in found]
        return pa.RecordBatch.from_arrays([
            row.field(key), pa.array(counts), pa.array(hits, pa.int64()), pa.array([len(n) for n in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
            pa.array([h > 0 for h in hits], pa.bool_()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        ], [key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    rows = docs.select(F.struct(F.col(key), F.col(text).cast("string").alias(text)).alias("row"))
    schema = (
        f"{key} {docs.schema[key].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string,"
        " contaminated boolean, spans array<struct<start: long, stop: long>>"
    )
    return _searched(rows, benchmark, text, item, width, report, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` with every hit span of :func:`contamination` cut out of its text; other rows as they were.

    A cut leaves one space. Columns, their order and the number of rows stay; a null text stays null.
    """
    names = docs.columns

    def cut(row, counts, found, items):
        columns = [row.field(name) for name in names]
        if any(found):
            old, new = columns[names.index(text)], []
            for value, spans in zip(old, found):
                if not spans:
                    new.append(value.as_py())
                    continue
                data, parts, at = value.as_py().encode(), [], 0
                for _, _, start, stop in spans:
                    parts.append(data[at:start])
                    at = stop
                new.append(b" ".join([*parts, data[at:]]).decode())
            columns[names.index(text)] = pa.array(new, old.type)
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    return _searched(rows, benchmark, text, item, width, cut, docs.schema)
