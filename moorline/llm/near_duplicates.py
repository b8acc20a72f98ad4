"""MinHash near-dedup with SetSketch registers (operator 5).

Each text becomes its set of distinct word shingles, and the set a sketch of mergeable
registers (:mod:`moorline.llm.setsketch`). Texts of one set form a class with one
representative. Representatives that agree on a band of registers are candidates; a joint
likelihood of the registers drops the hopeless ones; the rest are confirmed on full sets.

A bucket of many candidates isn't paired out. A member's own shingles, which no other candidate
has, bound its similarity to any of them; a member with too many of them is left out. The
others meet two leaders of their bucket, one of them with the fewest own shingles, which joins
nearly all of a group. Then only members outside a bucket's main component meet the others of
the bucket, block by block: a task compares the registers of two blocks and passes on the few
pairs that may be links. So no link between components is lost, and a group of copies costs a
few stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorline.llm.components import components
from moorline.llm.scratch import Scratch
from moorline.llm.setsketch import REGISTERS, band_keys, band_width, plausible, sketches
from moorline.llm.words import SPACED, mix, shingle_sets, slices, split_words

SKETCH = "id long, n long, hi long, lo long, registers binary"
PAIR_ROWS = 4096
FILTER_BITS = 1 << 23
BLOCK_ROWS = 256


def _binaries(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(data, np.uint8)[start:start + len(column) * width].reshape(len(column), width)


def _totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def sketch_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                sets, bounds = shingle_sets(split_words(part, SPACED), width)
                counts = np.diff(bounds)
                hi = _totals(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), bounds)
                lo = _totals(mix(sets ^ np.uint64(0x14057B7EF767814F)), bounds)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.rows), pa.array(counts), pa.array(hi.view(np.int64)),
                    pa.array(lo.view(np.int64)), _binaries(sketches(sets, bounds)),
                ], ["id", "n", "hi", "lo", "registers"])

    return run


def set_rows(wanted, width: int):
    """``(id, set)`` of the texts whose mark is in the filter ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.asarray(batch.column("mark"))
            rows = pa.array(np.flatnonzero(wanted.value[marks >> 3] >> (marks & 7) & 1))
            ids, texts = batch.column("id").take(rows), batch.column("text").take(rows)
            for part in slices(texts):
                sets, bounds = shingle_sets(split_words(part, SPACED), width)
                blobs = [sets[low:high].tobytes() for low, high in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(part.first, part.rows), pa.array(blobs, pa.binary())], ["id", "set"])

    return run


def _sets(texts: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """Shingle sets of the texts with one of the distinct ``ids``.

    A filter of fixed size goes to the tasks first, so that other texts are neither split nor
    shuffled; the join behind it is exact.
    """
    mark = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).cast("int")
    found = ids.select(mark.alias("mark")).groupBy(F.shiftright("mark", 3).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, mark & 7)")).alias("bits")
    ).toArrow()
    bits = np.zeros(FILTER_BITS >> 3, np.uint8)
    bits[np.asarray(found["at"])] = np.asarray(found["bits"])
    wanted = texts.sparkSession.sparkContext.broadcast(bits)
    rows = texts.where("id IS NOT NULL").select("id", "text", mark.alias("mark"))
    return rows.mapInArrow(set_rows(wanted, width), "id long, set binary").join(ids, "id", "left_semi").distinct()


def set_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 512):
            part = batch.slice(low, 512)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("set")]
            ids = np.repeat(np.asarray(part.column("id")), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets))], ["id", "element"])


def band_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch.column("registers"), REGISTERS), width)
            ids, n = (np.repeat(np.asarray(batch.column(c)), keys.shape[1]) for c in ("id", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(ids), pa.array(n)], ["key", "id", "n"])

    return run


def _hopeful(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), PAIR_ROWS):
                batch = whole.slice(low, PAIR_ROWS)
                a, b = (_matrix(batch.column(c), REGISTERS) for c in ("registers_a", "registers_b"))
                sizes = (np.asarray(batch.column(c)).astype(float) for c in ("n_a", "n_b"))
                yield batch.select(["a", "b"]).filter(pa.array(plausible(a, b, *sizes, least)))

    return run


def _confirmed(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                both = np.sort(np.concatenate([a, b]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = den * shared >= num * (len(a) + len(b) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def packed(key: tuple, group: pa.Table) -> pa.Table:
    """The members of a block as one row."""
    columns = {c: [np.asarray(group[c]).astype(np.int64).tobytes()] for c in ("id", "n", "own", "label")}
    registers = [b"".join(group["registers"].to_pylist())]
    return pa.table({"key": pa.array([key[0].as_py()], pa.int64()), **columns, "registers": registers})


def _across(num: int, den: int):
    """Pairs of two blocks, of different components, that may be similar enough.

    A pair that shares several bands meets in each of their buckets, and is passed on in the
    first of them alone. That one is tiled as well: both are in it and in different components,
    and if they are all that is in it, they have met before.
    """
    width = band_width(num / den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(len(batch)):
                row = batch.slice(number, 1).to_pylist()[0]
                a, b = ({c: np.frombuffer(row[c + end], np.int64) for c in ("id", "n", "own", "label")} for end in ("_a", "_b"))
                marks = [np.frombuffer(row["registers" + end], np.uint8).reshape(-1, REGISTERS) for end in ("_a", "_b")]
                shared = np.minimum((a["n"] - a["own"])[:, None], b["n"] - b["own"])
                bounded = den * shared >= num * (a["n"][:, None] + b["n"] - shared)
                x, y = np.nonzero(bounded & (a["label"][:, None] != b["label"]))
                keys = [band_keys(m, width) for m in marks]
                for low in range(0, len(x), PAIR_ROWS):
                    i, j = x[low:low + PAIR_ROWS], y[low:low + PAIR_ROWS]
                    keep = plausible(marks[0][i], marks[1][j], a["n"][i].astype(float), b["n"][j].astype(float), num / den)
                    i, j = i[keep], j[keep]
                    first = (keys[0][i] == keys[1][j]).argmax(axis=1)
                    here = keys[0][i, first] == row["key"]
                    one, two = a["id"][i[here]], b["id"][j[here]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["a", "b"])

    return run


def _beside(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The columns of ``table`` for both ends of each pair."""
    for end in ("a", "b"):
        side = table.select(F.col("id").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = pairs.join(side, end)
    return pairs


def _links(pairs: DataFrame, sets: DataFrame, scratch: Scratch, num: int, den: int) -> DataFrame:
    """The pairs that are similar enough on full sets."""
    return scratch.save(_beside(pairs, sets, "set").mapInArrow(_confirmed(num, den), "a long, b long").distinct())


def near_duplicates(
    docs: DataFrame, num: int = 80, den: int = 100, width: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``(key, n_shingles, component_id, kept)``.

    A-Z are lower-cased; words are runs of anything but white space. A text's set has its
    distinct shingles of ``width`` words, a shorter one its whole sequence of words, and a null
    or wordless one nothing: it is a component of its own. Rows are linked where ``den`` times
    the shared shingles is at least ``num`` times those of both together. ``component_id`` is
    the least key that links reach, and ``kept`` marks the row with that key. Rows that repeat
    a key count as one document. A row without a key is linked with nothing, has a null
    component and is kept. Other columns are not read, whatever their names.

    Shingles are 64-bit hashes, links are confirmed on the full sets of them. The chance that
    banding misses a link is one in 100,000 at just that similarity, and falls above it.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sketched = scratch.save(texts.mapInArrow(sketch_rows(width), SKETCH))
    classes = scratch.save(
        sketched.where("n > 0 AND id IS NOT NULL").groupBy("hi", "lo").agg(F.min("id").alias("rep"))
    )
    firsts = classes.select("hi", "lo", F.col("rep").alias("id"))
    reps = scratch.save(sketched.join(firsts, ["hi", "lo", "id"], "left_semi").dropDuplicates(["id", "hi", "lo"]).select("id", "n", "registers"))

    bands = reps.mapInArrow(band_rows(band_width(num / den)), "key long, id long, n long")
    full = bands.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key")
    met = scratch.save(bands.join(full, "key", "left_semi"))
    sets = scratch.save(_sets(texts, met.select("id").distinct(), width))
    own = (
        sets.mapInArrow(set_elements, "id long, element long")
        .groupBy("element").agg(F.min("id").alias("id"), F.max("id").alias("last")).where("id = last")
        .groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    )
    # Own shingles are of a document, so each is judged once; only bands of those that stay are joined.
    judged = met.select("id", "n").distinct().join(own, "id", "left").select("id", "n", F.coalesce("own", F.lit(0)).alias("own"))
    staying = scratch.save(judged.where(f"{den} * (n - own) >= {num} * n"))
    members = scratch.save(met.join(staying, ["id", "n"]).select("key", "id", "n", "own"))

    # One leader has the fewest shingles of its own, the other is any; hashes settle ties.
    scrambled = F.col("id").bitwiseXOR(F.col("key"))
    fewest = F.col("own") + F.pmod(F.xxhash64("id", "key"), F.lit(1 << 30)) / F.lit(1 << 30)
    leaders = members.groupBy("key").agg(F.min_by("id", fewest).alias("one"), F.max(scrambled).bitwiseXOR(F.col("key")).alias("two"))
    led = members.select("key", "id").join(leaders, "key")
    stars = led.select(F.col("one").alias("x"), F.col("id").alias("y")).union(led.select(F.col("two"), F.col("id")))
    tried = scratch.save(
        stars.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )
    hopeful = _beside(tried, reps, "n", "registers").mapInArrow(_hopeful(num / den), "a long, b long").distinct()
    links = _links(scratch.save(hopeful), sets, scratch, num, den)
    labels = components(links, scratch)

    placed = scratch.save(
        members.join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("key", "id", "n", "own", F.coalesce("label", "id").alias("label"))
    )
    # In a bucket of two, one has led the other already.
    mixed = placed.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.mode("label", deterministic=True).alias("main"),
        F.count(F.lit(1)).alias("size"),
    ).where("low < high AND size > 2").select("key", "main", F.ceil(F.col("size") / BLOCK_ROWS).alias("blocks"))
    split = (
        placed.join(mixed, "key").join(reps.select("id", "registers"), "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    )
    split = scratch.save(split)
    blob = "id binary, n binary, own binary, label binary, registers binary"
    every = split.groupBy("key", "block").applyInArrow(packed, f"key long, {blob}")
    apart = split.where("label <> main").groupBy("key", "block").applyInArrow(packed, f"key long, {blob}")
    columns = ("id", "n", "own", "label", "registers")
    tiles = apart.select("key", *[F.col(c).alias(f"{c}_a") for c in columns]).join(
        every.select("key", *[F.col(c).alias(f"{c}_b") for c in columns]), "key"
    )
    across = tiles.mapInArrow(_across(num, den), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")
    more = _links(scratch.save(across), sets, scratch, num, den)
    joined = components(links.union(more), scratch)
    scratch.drop(met, sets, staying, members, tried, placed, split, reps)

    rows = sketched.select("id", "n", "hi", "lo")
    return (
        rows.join(classes, ["hi", "lo"], "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("id").alias(key), F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("label", "rep", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )
