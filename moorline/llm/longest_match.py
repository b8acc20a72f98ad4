"""Token counts by a linear longest-match automaton (operator 10).

Greedy word pieces take the longest known piece from the left, again and again. The automaton
is a trie of the pieces with failure links: where a node has no way on, the link leads to the
node of what is left after the pieces that must come first are popped, and their number is
known beforehand. A word is counted in one pass, and no piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.piece_model import MARKER, read_model
from moorline.llm.pieces import MODEL_PATH
from moorline.llm.words import SPACED, slices, split_words

NOWHERE = -1
# Fewer words than this are finished one by one; a numpy step for them costs more.
FEW = 16


@dataclass
class Automaton:
    """Transitions as sorted keys ``state * 256 + byte``; links and popped pieces per state."""

    keys: np.ndarray
    next: np.ndarray
    link: np.ndarray
    popped: np.ndarray
    start: int

    @classmethod
    def of(cls, pieces: list[bytes]) -> Automaton:
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in pieces:
            at = 0
            for byte in piece:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    ends.append(False)
                at = children[at][byte]
            ends[at] = True
        link, popped = [NOWHERE] * len(children), [0] * len(children)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for byte, node in children[parent].items():
                todo.append(node)
                if ends[node]:
                    link[node], popped[node] = 0, 1
                    continue
                back, count = link[parent], popped[parent]
                while back != NOWHERE and byte not in children[back]:
                    back, count = link[back], count + popped[back]
                if back != NOWHERE:
                    link[node], popped[node] = children[back][byte], count
        keys = {at * 256 + byte: node for at, ways in enumerate(children) for byte, node in ways.items()}
        ordered = np.array(sorted(keys), np.int64)
        start = 0
        for byte in MARKER.encode():
            start = children[start].get(byte, NOWHERE) if start != NOWHERE else NOWHERE
        targets = np.array([keys[k] for k in ordered.tolist()], np.int32)
        return cls(ordered, targets, np.array(link, np.int32), np.array(popped, np.int32), start)

    def step(self, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        key = states.astype(np.int64) * 256 + bytes_
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], NOWHERE)

    def _one(self, word: bytes, state: int, count: int) -> int:
        """Pieces of the rest of one word; -1 if some of it matches nothing."""
        for byte in word:
            while True:
                key = state * 256 + byte
                at = int(np.searchsorted(self.keys, key))
                if at < len(self.keys) and self.keys[at] == key:
                    state = int(self.next[at])
                    break
                if self.link[state] == NOWHERE:
                    return -1
                count += int(self.popped[state])
                state = int(self.link[state])
        while state:
            if self.link[state] == NOWHERE:
                return -1
            count += int(self.popped[state])
            state = int(self.link[state])
        return count

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word (with the marker in front); -1 where a part matches nothing."""
        n = len(starts)
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        states = np.full(n, self.start, np.int64)
        counts = np.zeros(n, np.int64)
        if self.start == NOWHERE:
            return np.full(n, -1)
        # Words in order of falling length, so those with a byte at a step are a prefix.
        longer = n - np.searchsorted(np.sort(lengths), np.arange(int(lengths.max(initial=0)) + 1), side="right")
        for step, alive in enumerate(longer):
            if alive < FEW:
                for i in order[:alive]:
                    if states[i] != NOWHERE:
                        rest = data[starts[i] + step:ends[i]].tobytes()
                        counts[i] = self._one(rest, int(states[i]), int(counts[i]))
                        states[i] = 0 if counts[i] >= 0 else NOWHERE
                break
            words = order[:alive]
            words = words[states[words] != NOWHERE]
            byte = data[starts[words] + step].astype(np.int64)
            at = states[words]
            while len(words):
                onward = self.step(at, byte)
                moved = onward != NOWHERE
                states[words[moved]] = onward[moved]
                words, byte, at = words[~moved], byte[~moved], at[~moved]
                counts[words] += self.popped[at]
                at = self.link[at].astype(np.int64)
                lost = at == NOWHERE
                states[words[lost]] = NOWHERE
                words, byte, at = words[~lost], byte[~lost], at[~lost]
        open_ = np.flatnonzero(states > 0)
        while len(open_):
            counts[open_] += self.popped[states[open_]]
            states[open_] = self.link[states[open_]]
            open_ = open_[states[open_] > 0]
        counts[states == NOWHERE] = -1
        return counts


def token_counts(docs: DataFrame, path: str = MODEL_PATH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(key, n_words, n_tokens, n_unknown)``.

    A word is a run of anything but white space, with the model's marker in front of it; it
    takes the longest piece of the vocabulary from the left, again and again. A word with a
    part that no piece fits is one unknown token. A null, empty or blank text has no words.
    Rows that repeat stay; keys may be null and other columns are not read. The vocabulary is
    read on the driver from a file; its size is fixed by the model.
    """
    model = read_model(path)
    built = Automaton.of([model.pieces[i].encode() for i in model.usable()])
    spread = docs.sparkSession.sparkContext.broadcast((built.keys, built.next, built.link, built.popped, built.start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*spread.value)
        for batch in batches:
            for part in slices(batch.column(1)):
                words = split_words(part, SPACED, lower=False)
                _, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
                found = automaton.count(part.data, words.starts[first], words.ends[first])[number]
                total = np.concatenate([[0], np.cumsum(np.abs(found))])
                missed = np.concatenate([[0], np.cumsum(found < 0)])
                low, high = words.bounds[:-1], words.bounds[1:]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.rows), pa.array(high - low),
                    pa.array(total[high] - total[low]), pa.array(missed[high] - missed[low]),
                ], [key, "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(key), F.col(text).cast("string"))
    return rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, n_words long, n_tokens long, n_unknown long")
