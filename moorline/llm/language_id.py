"""Language ID by bit-sliced Bloom filters of n-grams (operator 7).

One table serves all languages: a row holds one bit per language, and an n-gram's rows, found
by several hashes, are and-ed to the set of languages that have it. A text counts the n-grams
each language has, takes off what false positives are expected to add, and the language with
the largest corrected count wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorline.llm.words import LOWER, Slice, mix, slices

GRAM = 4
# Hashes of an n-gram; table rows for each n-gram of the language with most of them, at least, and the least table.
HASHES, ROWS_PER_GRAM, LEAST_ROWS_LOG = 3, 16, 17
# The sample: so many rows of each language, of texts of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 400, 1 << 14
UNKNOWN = "und"

# Letters and bytes of other alphabets count; all else is a blank.
_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Each run of ``GRAM`` bytes without a blank inside, as a number, and each text's bounds."""
    data = _LETTERS[part.data]
    count = max(len(data) - GRAM + 1, 0)
    code = np.zeros(count, np.uint32)
    for k in range(GRAM):
        code |= data[k:k + count].astype(np.uint32) << np.uint32(8 * k)
    blank = data == 0x20
    whole = np.ones(count, bool)
    for k in range(1, GRAM - 1):
        whole &= ~blank[k:k + count]
    # A run may not reach into the next text.
    for edge in range(1, GRAM):
        at = part.offsets[1:-1] - edge
        whole[at[(at >= 0) & (at < count)]] = False
    places = np.flatnonzero(whole)
    return code[places], np.searchsorted(places, part.offsets)


@dataclass
class LanguageFilters:
    """Languages in order, the table of bits, and each language's chance of a false positive.

    Every n-gram of the sample is in the filter of its language; the table, of 2^k rows, grows with their number.
    """

    languages: list[str]
    table: np.ndarray
    chance: np.ndarray

    @staticmethod
    def rows(codes: np.ndarray, k: int, log: int) -> np.ndarray:
        return (mix(codes.astype(np.uint64) + np.uint64((k + 1) << 40)) >> np.uint64(64 - log)).astype(np.int64)

    @classmethod
    def fit(cls, texts: pa.Array, languages: pa.Array) -> LanguageFilters:
        """Filters of all n-grams of each language's texts."""
        names = sorted(set(languages.to_pylist()))
        words = max(1, -(-len(names) // 64))
        owner, known = np.array([names.index(x) for x in languages.to_pylist()]), []
        for number in range(len(names)):
            own = texts.take(pa.array(np.flatnonzero(owner == number)))
            found = [np.unique(grams(p)[0]) for p in slices(own)]
            known.append(np.unique(np.concatenate(found or [np.zeros(0, np.uint32)])))
        log = max(LEAST_ROWS_LOG, (ROWS_PER_GRAM * max(map(len, known), default=0)).bit_length())
        table = np.zeros((1 << log, words), np.uint64)
        for number, codes in enumerate(known):
            for k in range(HASHES):
                table[cls.rows(codes, k, log), number // 64] |= np.uint64(1 << (number % 64))
        filled = np.array([(table[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(names))])
        return cls(names, table, filled**HASHES)

    def predict(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: no letter) and score of each text of a slice."""
        codes, bounds = grams(part)
        totals, log = np.diff(bounds), len(self.table).bit_length() - 1
        support = np.zeros((part.rows, len(self.languages)))
        for word in range(self.table.shape[1]):
            column = self.table[:, word]
            found = column[self.rows(codes, 0, log)]
            for k in range(1, HASHES):
                found &= column[self.rows(codes, k, log)]
            for number in range(64 * word, min(64 * word + 64, len(self.languages))):
                sums = np.concatenate([[0], np.cumsum(found >> np.uint64(number % 64) & np.uint64(1), dtype=np.int64)])
                support[:, number] = sums[bounds[1:]] - sums[bounds[:-1]]
        # Of t n-grams that aren't a language's, t * chance still hit its filter.
        corrected = np.maximum((support - totals[:, None] * self.chance) / (1 - self.chance), 0)
        if not self.languages:
            return np.full(part.rows, -1), np.zeros(part.rows)
        best = corrected.argmax(axis=1)
        total = corrected.sum(axis=1)
        top = corrected[np.arange(part.rows), best]
        score = np.where(total > 0, top / np.where(total > 0, total, 1), 1 / len(self.languages))
        best[~self._lettered(part)] = -1
        return best, np.where(best < 0, 0.0, score)

    @staticmethod
    def _lettered(part: Slice) -> np.ndarray:
        """Texts with a letter; only texts without an ASCII letter are decoded to see."""
        ascii_ = np.concatenate([[0], np.cumsum((_LETTERS[part.data] != 0x20) & (part.data < 128))])
        out = ascii_[part.offsets[1:]] > ascii_[part.offsets[:-1]]
        for row in np.flatnonzero(~out):
            text = part.data[part.offsets[row]:part.offsets[row + 1]].tobytes().decode("utf-8", "replace")
            out[row] = any(c.isalpha() for c in text)
        return out


def held_out(key: str) -> F.Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(5)) == 0


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageFilters:
    """Filters from a sample of the rows that are not held out, the same at every run.

    Each language gives the ``SAMPLE_ROWS`` rows with the least hashes; texts over
    ``SAMPLE_BYTES`` bytes are passed over, whole texts of the others are used. Rows with a null
    key, text or language teach nothing.
    """
    own = docs.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.octet_length(text).alias("size"))
    own = own.where("id IS NOT NULL AND lang IS NOT NULL AND size <= " + str(SAMPLE_BYTES)).where(~held_out("id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = own.select("id", "lang", F.row_number().over(order).alias("rank")).where(F.col("rank") <= SAMPLE_ROWS)
    # At most SAMPLE_ROWS keys of each language are sent, whatever the table holds.
    ids = F.broadcast(chosen.select("id").distinct())
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        (F.octet_length("text") <= SAMPLE_BYTES) & F.col("lang").isNotNull() & ~held_out("id")
    ).join(ids, "id", "left_semi")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")
    sample = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_ROWS).toArrow()
    join = lambda name: pa.concat_arrays(sample[name].chunks) if len(sample) else pa.array([], pa.string())
    return LanguageFilters.fit(join("text"), join("lang"))


def language_id(docs: DataFrame, filters: LanguageFilters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(key, held_out, lang_pred, score)``.

    ``lang_pred`` is the language with the largest corrected count over the whole text, the
    first by name on ties, or ``und`` with score 0 for a null text or one without a letter.
    ``score`` is its share of all languages' corrected counts; a text with no known n-gram gets
    an equal share. ``held_out`` marks keys that never teach; it is false for a null key.
    Languages, sources and keys don't enter a prediction, and other columns are not read.
    """
    spread = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.table, filters.chance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = LanguageFilters(*spread.value)
        names = np.array([*filters.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch.column(1)):
                best, score = filters.predict(part)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.rows), pa.array(names[best], pa.string()), pa.array(score),
                ], [key, "lang_pred", "score"])

    rows = docs.select(F.col(key), F.col(text).cast("string"))
    found = rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, lang_pred string, score double")
    return found.select(key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "lang_pred", "score")
