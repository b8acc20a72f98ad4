"""Exact dedup by content-defined chunk recipes (operator 13).

Each text is cut where the bytes themselves say so: a rolling hash of the last bytes has a fixed
pattern. Equal passages give equal chunks wherever they stand. A chunk's identifier is a keyed
128-bit hash. Every chunk's bytes are compared with those of all others that have its identifier,
by an aggregation that sends one copy of a chunk per task; only identifiers that stand for one
content are used. From there on a text is its recipe, the ordered list of its identifiers, about a
hundredth of its size; equal recipes are equal texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch
from moorline.llm.words import mix, prefix_hashes, range_hashes

# Bytes that the rolling hash sees; shortest and longest chunk; bits of the pattern, so that a cut
# follows about 2^11 bytes after the shortest length.
WINDOW, SHORTEST, LONGEST, CUT_BITS = 32, 512, 16384, 11
ID_BYTES = 16
BLANKS = re.compile(rb"[\x20\x09-\x0D]+")

RECIPES = "id {kind}, recipe binary, text_sha256 string"


def normalised(data: bytes) -> bytes:
    """Each run of white space as one space."""
    return BLANKS.sub(b" ", data)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text; none for an empty one."""
    n = len(data)
    if n <= SHORTEST:
        return np.array([n] if n else [], np.int64)
    ends = np.arange(WINDOW, n + 1)
    rolled = range_hashes(prefix_hashes(data), ends - WINDOW, ends)
    marked = ends[(mix(rolled) >> np.uint64(64 - CUT_BITS)) == 0]
    found, last = [], 0
    while n - last > SHORTEST:
        at = np.searchsorted(marked, last + SHORTEST)
        last = int(min(marked[at] if at < len(marked) else n, last + LONGEST, n))
        found.append(last)
    if last < n:
        found.append(n)
    return np.array(found)


def chunks(data: bytes) -> list[bytes]:
    ends = cut_points(np.frombuffer(data, np.uint8)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def identifier(chunk: bytes, key: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=ID_BYTES, key=key.to_bytes(4, "big")).digest()


def _texts(column: pa.Array) -> Iterator[bytes]:
    """Texts of a batch as normalised UTF-8; a null one is empty."""
    for value in column.cast(pa.large_binary()):
        yield normalised(value.as_buffer().to_pybytes()) if value.is_valid else b""


def recipes(key: int):
    """Per row: its key, the identifiers of its chunks in order, and the digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, digests = [], []
            for text in _texts(batch.column(1)):
                lists.append(b"".join(identifier(x, key) for x in chunks(text)))
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.binary()), pa.array(digests, pa.string())], ["id", "recipe", "text_sha256"]
            )

    return run


def contents(key: int, most_bytes: int = 8 << 20):
    """Identifier and bytes of every chunk, each once per run of ``most_bytes`` of chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: set) -> pa.RecordBatch:
            ids, bodies = zip(*pairs)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(bodies, pa.binary())], ["chunk", "body"])

        pairs, held = set(), 0
        for batch in batches:
            for text in _texts(batch.column(0)):
                for x in chunks(text):
                    pair = (identifier(x, key), x)
                    if pair not in pairs:
                        pairs.add(pair)
                        held += len(x)
                    if held >= most_bytes:
                        yield out(pairs)
                        pairs, held = set(), 0
        if pairs:
            yield out(pairs)

    return run


def ambiguous(docs: DataFrame, key: int, text: str) -> DataFrame:
    """Identifiers that stand for more than one content among the chunks of all texts."""
    bodies = docs.select(F.col(text).alias("text")).mapInArrow(contents(key), "chunk binary, body binary")
    ends = bodies.groupBy("chunk").agg(F.min("body").alias("least"), F.max("body").alias("most"))
    return ends.where("least <> most").select("chunk")


def verified_recipes(docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """``(row, id, recipe, text_sha256)`` of each row, by identifiers that are held against the bytes.

    Should two contents ever share an identifier, the hash gets another key and all is done again.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    turn = 0
    while ambiguous(docs, turn, text).limit(1).count():
        turn += 1
    made = rows.mapInArrow(recipes(turn), RECIPES.format(kind=kind))
    return scratch.save(made.select(F.monotonically_increasing_id().alias("row"), "id", "recipe", "text_sha256"))


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(<key>, keep_id, group_size, kept, text_sha256)``.

    Texts are equal when they are identical after each run of white space became one space; a null
    text counts as empty, and empty texts are equal. Of equal texts the row with the smallest key
    stays, nulls last; of rows that repeat that key too, one stays. ``group_size`` counts rows.
    ``text_sha256`` is of the normalised text in UTF-8. Texts are read whole; a very long one is cut
    into chunks of at most ``LONGEST`` bytes. Other columns are not read, whatever their names.
    An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = verified_recipes(docs, key, text, scratch)
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first")
    # Written, so that the join deals rows out anew and splits a recipe that a third of them has.
    groups = scratch.save(rows.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), least))
    return rows.join(groups, "recipe").select(
        F.col("id").alias(key), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256",
    )


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` does not keep; all columns stay.

    Rows that share a key stay together where any of them is kept.
    """
    kept = exact_duplicates(docs, key, text).where("kept").select(F.col(key).alias("kept_key")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept.kept_key), "left_semi")
