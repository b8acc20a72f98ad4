"""Hard negatives by lists that a cluster of anchors shares (operator 12).

Anchors are clustered by direction. No anchor of a cluster is further from its centroid than the
cluster's radius, so the angle of a candidate to the centroid, less the radius, bounds its inner
product with each of them. A cluster sorts the candidates of a slice by that bound once. All its
members walk that one list, a step of candidates at a time, and a member leaves when the next
bound shows that nothing further down can be among what it looks for. The first walk finds the
positives, the second the negatives in the score window of each positive. Scores are whole
numbers, computed exactly, and a bound is only ever used to stop, so the result is exact.

Slices and clusters have a bounded number of rows, so the list of a cluster is cut into many
tasks however large the table is, and a hot direction or label spreads over many clusters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch

SLICE_ROWS, CLUSTER_ROWS, STEP = 2048, 256, 512
# Centroids are fitted to a sample of about so many anchors; every anchor is then assigned.
SAMPLE_ROWS, CENTROIDS, ROUNDS = 2048, 64, 8
# Whole numbers of this size and more take no part: their products would not fit a long.
LIMIT = 1 << 24
NONE = np.iinfo(np.int64).min
# What rounding can add to a bound, in proportion.
SLACK = 1e-9

CODED = "id long, label long, asked boolean, dim int, codes binary"
PACKED = "dim int, {keys}, ids binary, labels binary, codes binary, wanted binary"


def coded(scale: float):
    """Whole-number vectors of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, codes = [], [], []
            for row, value in enumerate(batch.column("vector")):
                if not value.is_valid or not len(value) or value.values.null_count:
                    continue
                vector = np.floor(np.asarray(value.values, dtype=np.float64) * scale)
                if np.isfinite(vector).all() and np.abs(vector).max() < LIMIT:
                    rows.append(row)
                    dims.append(len(vector))
                    codes.append(vector.astype(np.int32).tobytes())
            taken = batch.select(["id", "label", "asked"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(dims, pa.int32()), pa.array(codes, pa.binary())], ["id", "label", "asked", "dim", "codes"]
            )

    return run


def unit(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector keeps the zero direction."""
    codes = codes.astype(np.float64)
    norms = np.sqrt((codes * codes).sum(axis=1))
    return codes / np.where(norms > 0, norms, 1)[:, None], norms


def centroids(directions: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from the rows furthest apart."""
    found = [directions[0]]
    nearest = directions @ found[0]
    while len(found) < min(count, len(directions)):
        found.append(directions[int(nearest.argmin())])
        nearest = np.maximum(nearest, directions @ found[-1])
    centres = np.array(found)
    for _ in range(ROUNDS):
        own = (directions @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, directions)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def assigned(centres: dict[int, np.ndarray]):
    """The number of the nearest centroid beside each anchor; 0 for a dimension not sampled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            cluster = np.zeros(len(batch), np.int64)
            for dim in np.unique(dims):
                if int(dim) in centres:
                    at = np.flatnonzero(dims == dim)
                    codes = np.frombuffer(b"".join(batch.column("codes").take(pa.array(at)).to_pylist()), np.int32)
                    cluster[at] = (unit(codes.reshape(-1, dim))[0] @ centres[int(dim)].T).argmax(axis=1)
            yield batch.append_column("cluster", pa.array(cluster))

    return run


def packed(key: tuple, group: pa.Table) -> pa.Table:
    """All rows of a slice or a cluster as one row."""
    group = group.combine_chunks().sort_by([("id", "ascending")])
    blob = lambda name: np.asarray(group[name]).astype(np.int64).tobytes()
    wanted = b"".join(group["wanted"].to_pylist()) if "wanted" in group.column_names else b""
    names = ("dim", "slice") if len(key) == 2 else ("dim", "cluster", "part")
    return pa.table({n: pa.array([k.as_py()], k.type) for n, k in zip(names, key)} | {
        "ids": [blob("id")], "labels": [blob("label")], "codes": [b"".join(group["codes"].to_pylist())], "wanted": [wanted],
    })


class Best:
    """The k best of each slot by score, ties to the smaller id; ``need`` is what a newcomer must reach."""

    def __init__(self, need: np.ndarray, k: int):
        self.k, self.need = k, need.copy()
        self.slots = self.scores = self.ids = np.zeros(0, np.int64)

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        slots, scores, ids = (np.concatenate(x) for x in ((self.slots, slots), (self.scores, scores), (self.ids, ids)))
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        place = np.arange(len(slots)) - np.searchsorted(slots, slots)
        last = place == self.k - 1
        self.need[slots[last]] = scores[last]
        first = place < self.k
        self.slots, self.scores, self.ids = slots[first], scores[first], ids[first]


class Tile:
    """A cluster of anchors (``_q``) against a slice of candidates."""

    def __init__(self, row: dict):
        take = lambda name: np.frombuffer(row[name], np.int64)
        dim = row["dim"]
        self.ids, self.labels, self.codes = take("ids"), take("labels"), np.frombuffer(row["codes"], np.int32).reshape(-1, dim)
        self.q_ids, self.q_labels, self.q_codes = take("ids_q"), take("labels_q"), np.frombuffer(row["codes_q"], np.int32).reshape(-1, dim)
        self.wanted = take("wanted_q").reshape(len(self.q_ids), -1)
        directions, norms = unit(self.codes)
        q_directions, self.q_norms = unit(self.q_codes)
        # Products of whole numbers are exact where no part of the sum can leave the type.
        most = norms.max(initial=0) * self.q_norms.max(initial=0)
        kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64
        self.q_codes, codes = self.q_codes.astype(kind), self.codes.astype(kind)
        # The shared list: candidates by the angular bound, largest first, sorted once for all members.
        centre, length = unit(q_directions.sum(axis=0)[None, :])
        angle = lambda x: np.arccos(np.clip(x @ centre[0], -1, 1))
        radius = angle(q_directions[self.q_norms > 0]).max(initial=0) if length[0] else math.pi
        bounds = norms * np.cos(np.maximum(angle(directions) - radius - SLACK, 0)) + norms * SLACK
        order = np.lexsort((self.ids, -bounds))
        self.bounds, self.ids, self.labels, self.codes = bounds[order], self.ids[order], self.labels[order], codes[order]

    def walk(self, need) -> Iterator[tuple[np.ndarray, slice, np.ndarray]]:
        """Active members, the next candidates of the list, and their exact scores.

        ``need()`` is the least score that still helps each member; one that the bound of the next
        candidate doesn't reach is certain to have all it looks for.
        """
        for low in range(0, len(self.ids), STEP):
            reach = self.q_norms * self.bounds[low] + np.abs(self.q_norms * self.bounds[low]) * SLACK + 0.5
            active = np.flatnonzero(reach >= need())
            if not len(active):
                return
            at = slice(low, low + STEP)
            yield active, at, (self.q_codes[active] @ self.codes[at].T).astype(np.int64)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[Tile]:
    for batch in batches:
        for number in range(len(batch)):
            yield Tile(batch.slice(number, 1).to_pylist()[0])


def _out(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns))


def positives(k: int):
    """The k best rows of each anchor's own label in each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            best = Best(np.full(len(tile.q_ids), NONE), k)
            for active, at, scores in tile.walk(lambda: best.need):
                fits = (tile.q_labels[active, None] == tile.labels[at]) & (tile.q_ids[active, None] != tile.ids[at])
                row, column = np.nonzero(fits & (scores >= best.need[active, None]))
                best.offer(active[row], scores[row, column], tile.ids[at][column])
            yield _out({"anchor_id": tile.q_ids[best.slots], "positive_id": best.ids, "positive_score": best.scores})

    return run


def negatives(k: int, low: int, high: int):
    """The k best rows of other labels in each tile, for each score that an anchor's positives have.

    A negative's score times 100 lies from ``low`` to ``high`` times the positive's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            places = tile.wanted.shape[1]
            least, most = -((-low * tile.wanted) // 100), high * tile.wanted // 100
            # A window that nothing can be in asks for more than any score.
            closed = (tile.wanted == NONE) | (least > most)
            least = np.where(closed, np.iinfo(np.int64).max, least)
            best = Best(least.ravel(), k)
            for active, at, scores in tile.walk(lambda: best.need.reshape(-1, places).min(axis=1)):
                differs = tile.q_labels[active, None] != tile.labels[at]
                for place in range(places):
                    slots = active * places + place
                    row, column = np.nonzero(differs & (scores >= best.need[slots, None]) & (scores <= most[active, place, None]) & ~closed[active, place, None])
                    if len(row):
                        best.offer(slots[row], scores[row, column], tile.ids[at][column])
            yield _out({
                "anchor_id": tile.q_ids[best.slots // places], "place": best.slots % places + 1,
                "negative_id": best.ids, "negative_score": best.scores,
            })

    return run


def _first(frame: DataFrame, k: int, keys: list[str], score: str, tie: str, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return frame.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def hard_negatives(
    vectors: DataFrame, anchors: str, k: int = 5, n_positives: int = 5, low: int = 80, high: int = 100, scale: float = 256,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A component x counts as floor(``scale`` * x); a score is the inner product of two rows; higher
    scores come first, ties by smaller key. Anchors are the rows that the SQL condition ``anchors``
    picks. An anchor's positives are its first ``n_positives`` other rows of the same label. For
    each of them come the first ``k`` rows of other labels whose score times 100 lies from ``low``
    to ``high`` times the positive's, both ends included, fewer if there are fewer; a positive
    without any has no row.

    Rows with a null key, label or vector, an empty vector, or a component that is null, not finite
    or of 2^24 and more after scaling take no part. Vectors of different dimensions aren't compared.
    Of rows that repeat a key, the one with the least label, then the least vector by its bytes,
    takes part. Other columns are not read. Labels are whole numbers.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    picked = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"),
        F.coalesce(F.expr(anchors), F.lit(False)).alias("asked"),
    )
    whole = picked.where("id IS NOT NULL AND label IS NOT NULL").mapInArrow(coded(scale), CODED)
    least = F.min(F.struct("label", "dim", "codes", "asked")).alias("row")
    rows = scratch.save(whole.groupBy("id").agg(least).select("id", "row.*"))
    n, m = rows.count(), rows.where("asked").count()

    slices = max(1, math.ceil(n / SLICE_ROWS))
    tasks = min(slices, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = rows.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)))
    listed = scratch.save(numbered.drop("asked").groupBy("dim", "slice").applyInArrow(packed, PACKED.format(keys="slice long")))

    # Every so many anchors, by hash, so the sample stays near SAMPLE_ROWS whatever the table holds.
    step = max(1, math.ceil(m / SAMPLE_ROWS))
    sample = rows.where("asked").where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(step)) == 0).select("dim", "codes").toArrow()
    count, centres = min(CENTROIDS, math.ceil(m / CLUSTER_ROWS)), {}
    for dim in set(sample["dim"].to_pylist()):
        own = sample.filter(pc.equal(sample["dim"], dim))["codes"].to_pylist()
        centres[dim] = centroids(unit(np.frombuffer(b"".join(own), np.int32).reshape(-1, dim))[0], count)
    members = rows.where("asked").drop("asked").mapInArrow(assigned(centres), "id long, label long, dim int, codes binary, cluster long")
    members = scratch.save(members)
    sizes = members.groupBy("dim", "cluster").agg(F.count(F.lit(1)).alias("size"))
    part = F.pmod(F.xxhash64("id", F.lit(2)), F.ceil(F.col("size") / CLUSTER_ROWS)).alias("part")
    members = scratch.save(members.join(sizes, ["dim", "cluster"]).select("id", "label", "dim", "codes", "cluster", part))

    def tiles(frame: DataFrame) -> DataFrame:
        """Every cluster beside every slice of its dimension."""
        clusters = frame.groupBy("dim", "cluster", "part").applyInArrow(packed, PACKED.format(keys="cluster long, part long"))
        left = clusters.select("dim", *[F.col(c).alias(f"{c}_q") for c in ("ids", "labels", "codes", "wanted")])
        left = left.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")))
        return left.repartition(tasks, "dim", "slice").join(listed.drop("wanted").repartition(tasks, "dim", "slice"), ["dim", "slice"])

    found = tiles(members).mapInArrow(positives(n_positives), "anchor_id long, positive_id long, positive_score long")
    chosen = scratch.save(_first(found, n_positives, ["anchor_id"], "positive_score", "positive_id", "place"))

    # The scores of an anchor's positives travel with it, as many numbers for every anchor.
    by_place = F.collect_list(F.struct("place", "positive_score"))
    scores = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(by_place).alias("scores"))
    asking = members.join(scores, "id").mapInArrow(
        _with_windows(n_positives), "id long, label long, dim int, codes binary, cluster long, part long, wanted binary"
    )
    kind = "anchor_id long, place long, negative_id long, negative_score long"
    hard = _first(tiles(asking).mapInArrow(negatives(k, low, high), kind), k, ["anchor_id", "place"], "negative_score", "negative_id", "rank")
    return hard.join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _with_windows(n_positives: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = []
            for scores in batch.column("scores").to_pylist():
                own = np.full(n_positives, NONE)
                own[:len(scores)] = [x["positive_score"] for x in scores]
                wanted.append(own.tobytes())
            yield batch.drop_columns(["scores"]).append_column("wanted", pa.array(wanted, pa.binary()))

    return run
