"""Nearest neighbours by a block matrix join over int8 codes (operator 4).

Vectors are scaled to length one and rounded to int8 codes; each keeps how far the rounding
moved it. Codes are packed into blocks. A tile is a block of queries against a block of
candidates: one exact product of the codes gives every cosine up to a known error. A tile keeps,
of each query, the pairs that may still be among its nearest there; the lower bounds of all
tiles then tell which pairs can be among the nearest of all. These are computed again in double
precision on the vectors themselves, and a heap per query merges them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch

QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
CODED = "id long, asked boolean, dim int, codes binary, scale double, error double, norm double"
PACKED = "block long, dim int, ids binary, codes binary, scales binary, errors binary, norms binary"
SURVIVORS = "query_id long, vec_id long, low double, high double"
# What rounding of double sums can add to a bound.
SLACK = 1e-9


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for row, value in enumerate(column):
        if value.is_valid and len(value) and not value.values.null_count:
            yield row, np.asarray(value.values, dtype=np.float64)


def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of the usable vectors: no null, no zero, all components finite."""
    for batch in batches:
        rows, dims, codes, scales, errors, norms = [], [], [], [], [], []
        for row, vector in _vectors(batch.column(1)):
            length = np.sqrt(np.dot(vector, vector))
            if not np.isfinite(length) or length == 0 or batch.column(0)[row].as_py() is None:
                # The square of a finite component may overflow; scaling first avoids that.
                most = np.abs(vector).max()
                if not np.isfinite(most) or most == 0 or batch.column(0)[row].as_py() is None:
                    continue
                vector = vector / most
                length = np.sqrt(np.dot(vector, vector))
            unit = vector / length
            scale = np.abs(unit).max() / 127
            code = np.rint(unit / scale).astype(np.int8)
            near = code * scale
            rows.append(row)
            dims.append(len(vector))
            codes.append(code.tobytes())
            scales.append(scale)
            errors.append(np.sqrt(np.dot(unit - near, unit - near)))
            norms.append(np.sqrt(np.dot(near, near)))
        ids = batch.column(0).take(pa.array(rows, pa.int64())).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([
            ids, batch.column("asked").take(pa.array(rows, pa.int64())), pa.array(dims, pa.int32()), pa.array(codes, pa.binary()),
            pa.array(scales, pa.float64()), pa.array(errors, pa.float64()), pa.array(norms, pa.float64()),
        ], ["id", "asked", "dim", "codes", "scale", "error", "norm"])


def packed(key: tuple, group: pa.Table) -> pa.Table:
    """All rows of a block as one row."""
    group = group.combine_chunks().sort_by([("id", "ascending")])
    blob = lambda name, kind: np.asarray(group[name]).astype(kind).tobytes()
    return pa.table({
        "block": pa.array([key[0].as_py()], pa.int64()), "dim": pa.array([key[1].as_py()], pa.int32()),
        "ids": [blob("id", np.int64)], "codes": [b"".join(group["codes"].to_pylist())],
        "scales": [blob("scale", np.float64)], "errors": [blob("error", np.float64)], "norms": [blob("norm", np.float64)],
    })


def _unpack(row: dict, end: str) -> tuple[np.ndarray, ...]:
    codes = np.frombuffer(row[f"codes{end}"], np.int8).reshape(-1, row["dim"])
    return (np.frombuffer(row[f"ids{end}"], np.int64), codes, *(np.frombuffer(row[f"{c}{end}"]) for c in ("scales", "errors", "norms")))


def tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(len(batch)):
                row = batch.slice(number, 1).to_pylist()[0]
                q_ids, q, q_scale, q_error, q_norm = _unpack(row, "_q")
                c_ids, c, c_scale, c_error, c_norm = _unpack(row, "")
                # Products of codes are whole numbers; float32 holds them exactly to dimension 1040.
                kind = np.float32 if row["dim"] <= 1040 else np.float64
                near = (q.astype(kind) @ c.astype(kind).T).astype(np.float64) * q_scale[:, None] * c_scale
                reach = q_error[:, None] + q_norm[:, None] * c_error + SLACK
                low, high = near - reach, near + reach
                own = q_ids[:, None] == c_ids
                low[own] = high[own] = -np.inf
                # A key with several vectors may hold several places; the cut looks past them.
                count = min(k * int(np.unique(c_ids, return_counts=True)[1].max(initial=1)), len(c_ids))
                cut = np.partition(low, len(c_ids) - count, axis=1)[:, len(c_ids) - count] if count else np.zeros(len(q_ids))
                at, to = np.nonzero((high >= cut[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at]), pa.array(c_ids[to]), pa.array(low[at, to]), pa.array(high[at, to])],
                    ["query_id", "vec_id", "low", "high"],
                )

    return run


def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.empty(len(batch))
        for i, (a, b) in enumerate(zip(batch.column("of_query"), batch.column("of_candidate"))):
            a, b = (np.asarray(x.values, dtype=np.float64) for x in (a, b))
            a, b = (x / m if not 1e-100 < (m := np.abs(x).max()) < 1e100 else x for x in (a, b))
            scores[i] = np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b)))
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(scores)], ["query_id", "vec_id", "score"])


def nearest_of(k: int):
    """Heaps of the k nearest, over all queries of a partition; a query's rows are all in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {}
        for batch in batches:
            for query, candidate, score in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                heap = heaps.setdefault(query, [])
                if len(heap) < k:
                    heapq.heappush(heap, (score, -candidate))
                else:
                    heapq.heappushpop(heap, (score, -candidate))
        rows = [(q, rank, -c, s) for q, heap in heaps.items() for rank, (s, c) in enumerate(sorted(heap, reverse=True), 1)]
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "rank", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: str, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest cosine for each row that the SQL condition ``queries`` picks.

    Gives ``(query_id, rank, vec_id, score)``, nearest first, ties to the smaller key; fewer
    rows if there are fewer candidates. A row is no candidate of its own key. A vector that is
    null, empty, zero or has a null or non-finite component takes no part, nor has a row without
    a key. Vectors of different dimensions aren't compared. Rows that repeat a key and a vector
    count once; a key with several vectors is found by its nearest. No candidate is skipped:
    the bounds hold for every pair, so the result is exact. Other columns are not read.
    """
    scratch = Scratch(vectors.sparkSession, "vector-search")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.expr(queries).alias("asked")).distinct()
    codes = scratch.save(rows.mapInArrow(coded, CODED))
    asked = codes.where("asked")
    n, m = codes.count(), asked.count()
    candidate_blocks, query_blocks = max(1, math.ceil(n / CANDIDATE_ROWS)), max(1, math.ceil(m / QUERY_ROWS))

    def blocks(frame: DataFrame, count: int, seed: int) -> DataFrame:
        numbered = frame.withColumn("block", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(count)))
        return numbered.groupBy("block", "dim").applyInArrow(packed, PACKED)

    left = blocks(asked, query_blocks, 1)
    left = left.select("dim", *[F.col(c).alias(f"{c}_q") for c in ("ids", "codes", "scales", "errors", "norms")])
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    right = blocks(codes, candidate_blocks, 0)
    near = scratch.save(left.join(right, ["block", "dim"]).mapInArrow(tiles(k), SURVIVORS))

    # Pairs that can be among the k nearest of all tiles: those that reach the k-th largest lower bound.
    best = near.groupBy("query_id", "vec_id").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    order = Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")
    cut = best.select("query_id", F.col("low").alias("kth"), F.row_number().over(order).alias("place")).where(f"place <= {k}").where(f"place = {k}")
    pairs = best.join(cut, "query_id", "left").where("kth IS NULL OR high >= kth").select("query_id", "vec_id")
    usable = rows.where("id IS NOT NULL").join(codes.select("id").distinct(), "id", "left_semi")
    exact = (
        pairs.join(usable.select(F.col("id").alias("query_id"), F.col("vector").alias("of_query")), "query_id")
        .join(usable.select(F.col("id").alias("vec_id"), F.col("vector").alias("of_candidate")), "vec_id")
        .where(F.size("of_query") == F.size("of_candidate"))
        .mapInArrow(cosines, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    return exact.repartition("query_id").mapInArrow(nearest_of(k), "query_id long, rank int, vec_id long, score double")
