"""Prefix trie of conversations by double arrays (operator 11).

A conversation is a sequence of turns; equal beginnings are one path of a trie. Sequences are cut
into segments of a bounded number of turns, sorted by where they start and what they hold, and
dealt out in that order, so that a task gets segments that share prefixes. It packs them, a
bounded number at a time, into a double array: a node is a slot, and the child of slot ``s`` by
the dense number ``c`` of a turn is slot ``BASE[s] + c``, provided that ``CHECK`` of it is ``s``.
One traversal sums the weights of the segments that pass each node. Nodes near the top are in
the arrays of many tasks; their sums are merged by one aggregation over the name of the node.

The name of a node is a 128-bit hash of its path that grows by one turn at a time, so segments
are named from their own start. Two different paths share one with a chance of about 2^-128 a pair.

Sums over subtrees need no walk over levels: each node belongs to its least conversation, a
conversation hands the sum of what it owns to each node above that it passes, and a second
traversal of the same arrays adds these up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch

# Turns of a segment; turns that go into one double array; turns of a numbering block, as a power of 2.
SEGMENT, ARRAY_TURNS, BLOCK_BITS = 512, 100_000, 12
# Turns that say where in the order a segment goes.
SORTED_BY = 16
PIECE_BYTES = 64 << 10

NODES = "n1 long, n2 long, p1 long, p2 long, depth long, bytes long, conv_id long, first long, second long"
ROOT = -1


def _hashes(*parts) -> tuple[Column, Column]:
    """A 128-bit hash as two columns."""
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def running(frame: DataFrame, key: str, block: Column, order: Sequence, sums: dict[str, Column]) -> DataFrame:
    """``frame`` with sums over the rows of ``key`` so far, in an order that ``block`` rises with.

    Sums run within each block, and what the earlier blocks of the key hold is added. So the rows
    of a hot key are sorted and summed in many tasks; one sees a row for each of its blocks.
    ``frame`` is read twice and should be a written table.
    """
    marked = frame.withColumn("block", block)
    so_far = Window.partitionBy(key, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = marked.groupBy(key, "block").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = totals.select(key, "block", *[F.sum(n).over(earlier).alias(f"before_{n}") for n in sums])
    before = before.where(F.coalesce(*[F.col(f"before_{n}") for n in sums]).isNotNull())
    within = marked.withColumns({n: F.sum(c).over(so_far) for n, c in sums.items()})
    whole = within.join(before, [key, "block"], "left")
    return whole.select(*frame.columns, *[(F.col(n) + F.coalesce(f"before_{n}", F.lit(0))).alias(n) for n in sums])


class DoubleArray:
    """BASE and CHECK over dense codes; roots have CHECK ``ROOT``, free slots less."""

    FREE = -2

    def __init__(self, codes: int, nodes: int):
        self.base = np.zeros(nodes + codes, np.int64)
        self.check = np.full(nodes + codes, self.FREE, np.int64)
        # No slot below ``low`` is free, none from ``top`` on is used.
        self.low = self.top = 0

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, self.FREE, np.int64)])

    def _free(self, count: int) -> np.ndarray:
        """The first free slots; the array grows for them."""
        width = 4 * count + 64
        while True:
            found = np.flatnonzero(self.check[self.low:self.low + width] == self.FREE)[:count] + self.low
            if len(found) == count:
                break
            self._grow(self.low + width)
            width *= 2
        if count:
            self.low = int(found[0])
        return found

    def _use(self, slots: np.ndarray, parents) -> None:
        self.check[slots] = parents
        self.top = max(self.top, int(slots.max(initial=-1)) + 1)

    def roots(self, count: int) -> np.ndarray:
        slots = self._free(count)
        self._use(slots, ROOT)
        return slots

    def _place(self, codes: np.ndarray) -> int:
        """A base at which the slots of all ``codes``, ascending, are free: the first of some, or past the last used."""
        for slot in self._free(16).tolist():
            at = codes + (slot - codes[0])
            self._grow(int(at[-1]) + 1)
            if (self.check[at] == self.FREE).all():
                return slot - int(codes[0])
        self._grow(self.top + int(codes[-1] - codes[0]) + 1)
        return self.top - int(codes[0])

    def add(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Children of parents without any so far; pairs are distinct and sorted."""
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])) if len(parents) else np.zeros(0, int)
        sizes = np.diff(np.append(starts, len(parents)))
        for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            own = codes[start:start + size]
            self.base[parents[start]] = base = self._place(own)
            self._use(own + base, parents[start])
        single = starts[sizes == 1]
        slots = self._free(len(single))
        self.base[parents[single]] = slots - codes[single]
        self._use(slots, parents[single])

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each slot by each code; ``ROOT`` where there is none."""
        to = self.base[slots] + codes
        there = (to >= 0) & (to < len(self.check))
        to = np.where(there, to, 0)
        return np.where(there & (self.check[to] == slots), to, ROOT)


def dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Pairs of longs as numbers from 0, equal for equal pairs."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), np.int64)
    if len(order):
        new[0] = 0
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _packed_nodes(batch: pa.Table) -> pa.RecordBatch:
    """Nodes of one double array over a run of segments, with the sums of the weights that pass them."""
    batch = batch.combine_chunks()
    column = lambda name: np.asarray(batch[name])
    turns = batch["turns"].chunk(0)
    offsets = np.asarray(turns.offsets).astype(np.int64)
    offsets, flat = offsets - offsets[0], turns.flatten()
    field = lambda name: np.asarray(flat.field(name))
    h1, h2, x1, x2, size = (field(n) for n in ("h1", "h2", "x1", "x2", "bytes"))
    codes = dense(h1, h2)
    starts, lengths = offsets[:-1], np.diff(offsets)
    s1, s2, at, conv, first, second = (column(n) for n in ("s1", "s2", "start", "conv_id", "first", "second"))

    array = DoubleArray(int(codes.max(initial=0)) + 1, len(codes) + len(batch))
    # Pack: level by level, the distinct pairs of a node and a turn below it.
    number = dense(s1, s2)
    root_slots = array.roots(int(number.max(initial=-1)) + 1)
    slots, level = root_slots[number], 0
    while (alive := lengths > level).any():
        rows = np.flatnonzero(alive)
        own = codes[starts[rows] + level]
        order = np.lexsort((own, slots[rows]))
        p, c = slots[rows][order], own[order]
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])])
        array.add(p[new], c[new])
        slots = slots.copy()
        slots[rows] = array.step(slots[rows], own)
        level += 1

    # Traverse: sums and names of the nodes that the segments pass.
    n = len(array.check)
    names = {k: np.zeros(n, np.int64) for k in ("n1", "n2", "p1", "p2", "depth", "bytes")}
    sums = {"first": np.zeros(n, np.int64), "second": np.zeros(n, np.int64)}
    least = np.full(n, np.iinfo(np.int64).max)
    slots, rows, level = root_slots[number], np.arange(len(batch)), 0
    k1, k2 = s1.copy(), s2.copy()
    up1, up2 = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
    while len(rows):
        here = slots[rows]
        if level:
            assert (here != ROOT).all()
        # Nodes where a segment starts belong to the one before it; the root has none before.
        counted = rows if level else rows[at[rows] == 0]
        here = slots[counted]
        for k, v in (("n1", k1), ("n2", k2), ("p1", up1), ("p2", up2)):
            names[k][here] = v[counted]
        names["depth"][here] = at[counted] + level
        if level:
            names["bytes"][here] = size[starts[counted] + level - 1]
        np.add.at(sums["first"], here, first[counted])
        np.add.at(sums["second"], here, second[counted])
        np.minimum.at(least, here, conv[counted])
        rows = rows[lengths[rows] > level]
        up1[rows], up2[rows] = k1[rows], k2[rows]
        k1[rows] ^= x1[starts[rows] + level]
        k2[rows] ^= x2[starts[rows] + level]
        slots[rows] = array.step(slots[rows], codes[starts[rows] + level])
        level += 1
    used = np.flatnonzero(least != np.iinfo(np.int64).max)
    columns = [names["n1"], names["n2"], names["p1"], names["p2"], names["depth"], names["bytes"], least, sums["first"], sums["second"]]
    kinds = [x.split()[0] for x in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c[used]) for c in columns], kinds)


def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the double arrays over sorted segments, about ``ARRAY_TURNS`` turns in each."""
    held, turns = [], 0
    for batch in batches:
        lengths = np.asarray(pc.list_value_length(batch.column("turns")))
        low = 0
        while low < len(batch):
            high = low + int(np.searchsorted(np.cumsum(lengths[low:] + 1), ARRAY_TURNS - turns)) + 1
            part = batch.slice(low, high - low)
            held.append(part)
            turns += int(lengths[low:high].sum()) + len(part)
            low = high
            if turns >= ARRAY_TURNS:
                yield _packed_nodes(pa.Table.from_batches(held))
                held, turns = [], 0
    if held:
        yield _packed_nodes(pa.Table.from_batches(held))


def numbered_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, pos, h1, h2, bytes)``: turns by number from 1, each as a hash of its role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    h1, h2 = _hashes(role, text)
    small = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), h1.alias("h1"), h2.alias("h2"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = [F.col("turn").asc_nulls_first(), "h1", "h2"]
    # Blocks of turn numbers rise with them; null comes first.
    block = F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(-(1 << 62)))
    return scratch.save(running(scratch.save(small), "conv_id", block, order, {"pos": F.lit(1).cast("long")}).drop("turn"))


def rebuilt(turns: DataFrame, base: Column, head: Column, most_head: int) -> DataFrame:
    """``(conv_id, d, h1, h2, bytes)``: the first ``head`` turns of conversation ``base``, then the own turns after as many.

    ``base`` and ``head`` are of ``conv_id``; no head is longer than ``most_head``.
    """
    convs = turns.groupBy("conv_id").agg(F.least(F.max("pos"), F.lit(most_head)).alias("length"))
    lengths = convs.select(F.col("conv_id").alias("base"), "length")
    plan = convs.select("conv_id", base.alias("base"), head.alias("head")).join(lengths, "base", "left")
    plan = plan.select("conv_id", "base", "head", F.least("head", F.coalesce("length", F.lit(0))).alias("taken"))
    heads = turns.where(F.col("pos") <= most_head).withColumnRenamed("conv_id", "base")
    heads = heads.join(plan.where("taken > 0"), "base").where("pos <= taken").select("conv_id", F.col("pos").alias("d"), "h1", "h2", "bytes")
    own = turns.join(plan, "conv_id").where("pos > head")
    return heads.unionByName(own.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("d"), "h1", "h2", "bytes"))


def segments(sequences: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, start, s1, s2, turns, e1, e2, last)``: runs of up to ``SEGMENT`` turns, named by where they start and end.

    Every conversation has a segment that starts at 0, be it empty.
    """
    x1, x2 = _hashes("d", "h1", "h2")
    turn = F.struct("d", "h1", "h2", x1.alias("x1"), x2.alias("x2"), "bytes")
    number = F.floor((F.col("d") - 1) / SEGMENT).cast("long")
    made = sequences.withColumns({"segment": number, "x1": x1, "x2": x2}).groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")
    )
    order = Window.partitionBy("conv_id").orderBy("segment")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    none = F.coalesce("turns", F.array().cast("array<struct<d:bigint,h1:bigint,h2:bigint,x1:bigint,x2:bigint,bytes:bigint>>"))
    zero = F.lit(0).cast("long")
    whole = convs.join(made, "conv_id", "left").select(
        "conv_id", (F.coalesce("segment", zero) * SEGMENT).alias("start"), none.alias("turns"),
        *[F.coalesce(F.bit_xor(f"x{i}").over(before), zero).alias(f"s{i}") for i in (1, 2)],
        *[F.coalesce(F.bit_xor(f"x{i}").over(upto), zero).alias(f"e{i}") for i in (1, 2)],
        F.lead("segment").over(order).isNull().alias("last"),
    )
    return scratch.save(whole)


def nodes_of(weighted: DataFrame) -> DataFrame:
    """Nodes of all tasks' arrays, those of one name merged: sums of the weights and the least conversation."""
    sorted_ = weighted.select("start", "s1", "s2", "turns", "conv_id", "first", "second")
    ids = F.transform("turns", lambda x: x["h1"])
    dealt = sorted_.repartitionByRange("start", "s1", "s2", F.slice(ids, 1, SORTED_BY), "conv_id")
    dealt = dealt.sortWithinPartitions("start", "s1", "s2", ids, "conv_id")
    found = dealt.mapInArrow(tries, NODES)
    names = ["n1", "n2"]
    return found.groupBy(*names).agg(
        *[F.first(c).alias(c) for c in ("p1", "p2", "depth", "bytes")],
        F.min("conv_id").alias("conv_id"), F.sum("first").alias("first"), F.sum("second").alias("second"),
    )


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ascending numbers of one node as comma-joined text, so long lists are dealt out as few rows."""
    rows, held, node, size = [], [], None, 0

    def close():
        rows.append((*node, int(held[0]), ",".join(held)))
        held.clear()

    def out():
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["n1", "n2", "from", "body"])

    for batch in batches:
        for n1, n2, conv in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "conv_id"))):
            if held and (node != (n1, n2) or size >= PIECE_BYTES):
                close()
                size = 0
                if len(rows) >= 1024:
                    yield out()
                    rows.clear()
            node = n1, n2
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        close()
        yield out()


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, one after the other."""
    node, state, rows = None, None, []
    kinds = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        for n1, n2, body in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "body"))):
            if node == (n1, n2):
                state.update(b"," + body.encode())
                continue
            if node:
                rows.append((*node, state.hexdigest()))
            node, state = (n1, n2), hashlib.sha256(body.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], kinds.names)
            rows = []
    if node:
        yield pa.RecordBatch.from_pylist([{"n1": node[0], "n2": node[1], "ends_sha256": state.hexdigest()}], kinds)


def end_digests(ends: DataFrame) -> DataFrame:
    """``(n1, n2, ends_sha256)`` of the conversations that end at a node, numerically ascending.

    A hash takes its bytes in order. Numbers are sorted and joined into long pieces in as many tasks as
    there are; the last step streams the few pieces of a node and keeps none of them.
    """
    keys = ["n1", "n2"]
    dealt = ends.repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    joined = dealt.mapInArrow(pieces, "n1 long, n2 long, `from` long, body string")
    return joined.repartition(*keys).sortWithinPartitions(*keys, "from").mapInArrow(digests, "n1 long, n2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, most_head: int = 0) -> DataFrame:
    """One row per distinct beginning of the conversations in ``turns (conv_id, turn, role, text)``.

    Conversations are their turns by ``turn``, null first; turns of one number follow each other by a
    hash of role and text, the same on every run. A null role or text is empty. Rows without a
    ``conv_id`` take no part; rows that repeat all values are turns of their own. With ``base`` and
    ``head``, columns over ``conv_id``, a conversation becomes the first ``head`` turns of
    conversation ``base`` (all if it has fewer, none if it is absent), then its own turns after its
    first ``head``; ``head`` is at most ``most_head``. Other columns are not read.

    A node is a distinct sequence of the first ``depth`` turns, from the root without any. Conversations
    that start with it are its members, those that end there its ends, and a subtree includes its top:

    - ``conv_id``: the smallest member; ``parent_conv_id``: that of the parent, null for the root
    - ``n_convs`` members, ``n_children`` children, ``n_leaves`` nodes without children in the subtree
    - ``saved_tokens``: over the subtree, each node's members but one times the UTF-8 bytes of its last text
    - ``ends_sha256``: lower-case hex SHA-256 of the ends' numbers, ascending, joined by commas

    No conversations give no rows. Long conversations are held in segments, each at most ``SEGMENT`` turns.
    """
    scratch = Scratch(turns.sparkSession, "prefix-trie")
    numbered = numbered_turns(turns, scratch)
    convs = scratch.save(numbered.select("conv_id").distinct())
    if base is None:
        sequences = numbered.withColumnRenamed("pos", "d")
    else:
        sequences = rebuilt(numbered, base.cast("long"), head.cast("long"), most_head)
    parts = segments(sequences, convs, scratch)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    names, above = ["n1", "n2"], ["p1", "p2"]
    nodes = nodes_of(parts.withColumns({"first": one, "second": zero})).drop("second").withColumnRenamed("first", "n_convs")
    nodes = scratch.save(nodes)

    children = nodes.where("depth > 0").groupBy(*above).agg(F.count(one).alias("n_children"))
    children = children.select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), "n_children")
    nodes = nodes.join(children, names, "left").withColumn("n_children", F.coalesce("n_children", zero))
    leaf, saved = F.when(F.col("n_children") == 0, one).otherwise(zero), (F.col("n_convs") - 1) * F.col("bytes")
    nodes = scratch.save(nodes.withColumns({"leaf": leaf, "saved": saved}))

    # A conversation owns the nodes of which it is the least member: those from some depth on.
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("from_depth"), F.sum("leaf").alias("first"), F.sum("saved").alias("second")
    )
    handed = parts.join(owned, "conv_id").where("start < from_depth AND (first > 0 OR second > 0)")
    handed = handed.withColumn("turns", F.filter("turns", lambda x: x["d"] < F.col("from_depth")))
    passed = nodes_of(handed.where("from_depth > 0")).select(*names, F.col("first").alias("more_leaves"), F.col("second").alias("more_saved"))
    own = running(
        nodes, "conv_id", -F.shiftright("depth", BLOCK_BITS), [F.desc("depth")], {"own_leaves": F.col("leaf"), "own_saved": F.col("saved")}
    )
    ends = parts.where("last").select(F.col("e1").alias("n1"), F.col("e2").alias("n2"), "conv_id")
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("depth").alias("above_depth"), F.col("conv_id").alias("parent_conv_id"))
    whole = own.join(passed, names, "left").join(end_digests(ends), names, "left").withColumn("above_depth", F.col("depth") - 1)
    return whole.join(parents, [*above, "above_depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("own_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("own_saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
