"""Dependencies between jobs, held as an edge table."""

from __future__ import annotations

from functools import reduce
from itertools import count
from random import Random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.session import drop_tables, materialize, materialize_with

ROUNDS_PER_PLAN = 32
# Steps along the edges that are planned and written together where every one is kept, and where the last one is.
STEPS_PER_TABLE, CHAIN_PER_TABLE = 5, 10
# Orders that nodes are labelled in at once, and the part of the edges that a round of trimming may leave to be followed by another.
ORDERS, LEAST_TRIMMED = 4, 0.9


class CycleError(ValueError):
    """A dependency cycle; ``members`` has the jobs on cycles, and no others, each with its cycle."""

    def __init__(self, members: DataFrame, count: int):
        self.members = members
        folder = members.inputFiles()[0].rsplit("/", 1)[0]
        super().__init__(f"dependency cycle; {count} jobs are on one, listed in {folder}")


def direct_dependencies(edges: DataFrame, job_id: str, child: str = "dependent_job_id") -> DataFrame:
    """Edges that start at one job."""
    return edges.where(F.col(child) == F.lit(job_id))


def _links(edges: DataFrame, child: str, parent: str) -> DataFrame:
    linked = F.col(child).isNotNull() & F.col(parent).isNotNull()
    return edges.where(linked).select(F.col(child).alias("child"), F.col(parent).alias("parent")).distinct()


def _compact(rounds: list[DataFrame], written: list[DataFrame]) -> list[DataFrame]:
    """Write the rounds so far as one table, so that a deep graph does not grow a deep plan.

    The tables ``written`` for them are dropped then, and the list becomes the new one.
    """
    if len(rounds) < ROUNDS_PER_PLAN:
        return rounds
    whole = materialize(reduce(DataFrame.union, rounds), "rounds")[0]
    drop_tables(*written)
    written[:] = [whole]
    return [whole]


def _steps(
    links: DataFrame, start: DataFrame, source: str, target: str, first: int, number: str, count: int = STEPS_PER_TABLE
) -> list[DataFrame]:
    """Distinct nodes that are 1 to ``count`` edges from ``start``, a frame each with its step."""
    found, at = [], start
    for step in range(first, first + count):
        at = links.join(at.select(F.col("node").alias("from_node")), F.col(source) == F.col("from_node"), "left_semi")
        at = at.select(F.col(target).alias("node")).distinct()
        found.append(at.withColumn(number, F.lit(step)))
    return found


def dependency_levels(
    edges: DataFrame, child: str = "dependent_job_id", parent: str = "parent_job_id", node: str = "job_id"
) -> DataFrame:
    """Level of every node: 0 without parents, else one more than its deepest parent.

    A node has level k or more if one of its parents has k - 1 or more, so each round keeps the
    children of those that the last one kept: one semi join, however many paths lead to a node.
    ``STEPS_PER_TABLE`` rounds are planned and written together. Rounds that keep all nodes
    there were have found a cycle; it raises a :class:`CycleError` with the jobs on it.
    """
    links, _ = materialize(_links(edges, child, parent), "edges")
    ends = [edges.select(F.col(child).alias("node")), links.select(F.col("parent").alias("node"))]
    levels = [nodes.where(F.col("node").isNotNull()).withColumn("level", F.lit(0)) for nodes in ends]
    written, level = [], 0
    # At level 0 or more there is every node; what has none below it leads nowhere.
    deep, n_deep = links.select(F.col("parent").alias("node")), -1
    while n_deep:
        rounds = reduce(DataFrame.union, _steps(links, deep, "parent", "child", level + 1, "level"))
        level += STEPS_PER_TABLE
        at_least = {f"from_{k}": F.count_if(F.col("level") == k) for k in (level - 1, level)}
        table, told = materialize_with(rounds, "levels", **at_least)
        n_deep = told[f"from_{level}"]
        if n_deep and n_deep == told[f"from_{level - 1}"]:
            deep = table.where(F.col("level") == level)
            open_edges = links.join(deep.select(F.col("node").alias("child")), "child", "left_semi").select("child", "parent")
            raise CycleError(*materialize(dependency_cycles(open_edges, "child", "parent", node), "cycle"))
        written.append(table)
        levels = _compact([*levels, table], written)
        deep = levels[-1].where(F.col("level") == level)
    return reduce(DataFrame.union, levels).groupBy(F.col("node").alias(node)).agg(F.max("level").alias("level"))


def dependency_closure(
    edges: DataFrame, job_id: str, child: str = "dependent_job_id", parent: str = "parent_job_id", node: str = "job_id"
) -> DataFrame:
    """Every job that ``job_id`` needs, directly or through others, with the least distance.

    ``STEPS_PER_TABLE`` steps are planned and written together, without those found before.
    """
    links, _ = materialize(_links(edges, child, parent), "edges")
    start = links.where(F.col("child") == F.lit(job_id)).select(F.col("child").alias("node")).distinct()
    rounds, written, distance, found = [start.withColumn("distance", F.lit(0))], [], 0, 1
    at = start
    while found:
        steps = reduce(DataFrame.union, _steps(links, at, "child", "parent", distance + 1, "distance"))
        seen = reduce(DataFrame.union, rounds).select(F.col("node").alias("seen"))
        nearest = steps.groupBy("node").agg(F.min("distance").alias("distance"))
        distance += STEPS_PER_TABLE
        last = F.count_if(F.col("distance") == distance)
        table, told = materialize_with(nearest.join(seen, F.col("node") == F.col("seen"), "left_anti"), "steps", last=last)
        found = told["last"]
        written.append(table)
        rounds = _compact([*rounds, table], written)
        at = rounds[-1].where(F.col("distance") == distance)
    return reduce(DataFrame.union, rounds).where("distance > 0").select(F.col("node").alias(node), "distance")


def _numbered(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(node, number)`` of all ends, and the edges between the numbers; written tables. No two nodes share a number."""
    ends = links.select(F.col("child").alias("node")).union(links.select("parent")).distinct()
    for salt in count():
        nodes, _ = materialize(ends.withColumn("number", F.xxhash64("node", F.lit(salt))), "nodes")
        if nodes.groupBy("number").count().where("count > 1").isEmpty():
            break
        drop_tables(nodes)
    for end in ("child", "parent"):
        names = nodes.select(F.col("node").alias("named"), F.col("number").alias(f"{end}_number"))
        links = links.join(names, F.col(end) == F.col("named")).drop("named")
    return nodes, materialize(links.select(F.col("child_number").alias("child"), F.col("parent_number").alias("parent")), "edges")[0]


def _labelled(links: DataFrame, masks: list[int]) -> DataFrame:
    """For each node and mask the first node that leads to it, ``from_i``, and the first that it leads to, ``to_i``.

    Nodes are numbers and each is its own label, turned by the mask; the least label is the first.
    Numbers are hashes, so every mask puts the nodes in another order. A written table.
    """
    ends = links.select(F.col("child").alias("node")).union(links.select("parent")).distinct()
    names = [f"{way}_{i}" for way in ("from", "to") for i in range(len(masks))]
    own = [F.col("node").bitwiseXOR(F.lit(mask)) for mask in masks * 2]
    labels, _ = materialize(ends.select("node", *[c.alias(name) for c, name in zip(own, names)]), "labels")
    # Whom a node tells what: children and itself what it is reached from, parents and itself what it reaches.
    yes, no = F.lit(True), F.lit(False)
    down, up = links.select(F.col("parent").alias("node"), F.col("child").alias("to"), yes, no), links.select("child", "parent", no, yes)
    told = down.union(up).union(ends.select("node", F.col("node").alias("to"), yes, yes)).toDF("node", "to", "down", "up")
    told, _ = materialize(told, "told")
    while True:
        rows = labels.select("node", *names)
        for _ in range(CHAIN_PER_TABLE):
            least = [F.min(F.when(F.col("down" if name.startswith("from") else "up"), F.col(name))).alias(name) for name in names]
            rows = rows.join(told, "node").groupBy(F.col("to").alias("node")).agg(*least)
        before = labels.select(F.col("node").alias("same"), F.struct(*names).alias("before"))
        stepped = rows.join(before, F.col("node") == F.col("same")).drop("same")
        after, counts = materialize_with(stepped, "labels", moved=F.count_if(F.struct(*names) != F.col("before")))
        drop_tables(labels)
        labels = after
        if not counts["moved"]:
            drop_tables(told)
            return labels.drop("before")


def _between(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the distinct ``nodes``."""
    inside = links.join(nodes.select(F.col("node").alias("child")), "child", "left_semi")
    return inside.join(nodes.select(F.col("node").alias("parent")), "parent", "left_semi").select("child", "parent")


def _trimmed(links: DataFrame) -> tuple[DataFrame, int]:
    """The edges without most that no cycle leads to or that lead to none; a written table and its rows.

    Each round drops the nodes that no chain of ``STEPS_PER_TABLE`` edges leads to, and those that lead into none.
    It ends with the round that drops few edges, so that a long chain doesn't take a round for each of its parts.
    """
    links, rows = materialize(links, "edges")
    before = 2 * rows
    while rows and rows < LEAST_TRIMMED * before:
        before = rows
        for source, target in (("child", "parent"), ("parent", "child")):
            chained = _steps(links, links.select(F.col(source).alias("node")), source, target, 1, "step")[-1].select("node")
            nodes, _ = materialize(chained, "chained")
            left, rows = materialize(_between(links, nodes), "edges")
            drop_tables(links, nodes)
            links = left
    return links, rows


def dependency_cycles(
    edges: DataFrame, child: str = "dependent_job_id", parent: str = "parent_job_id", node: str = "job_id"
) -> DataFrame:
    """``(node, cycle_id)`` of the jobs that are on a cycle, and of no others.

    Jobs that can reach each other share a ``cycle_id``, the least of them; a job that needs itself
    is a cycle of its own. Most nodes that only wait on a cycle, or are only needed by one, are
    trimmed from both ends. Then labels go along the edges both ways, until every node has the
    first node that leads to it and the first that it leads to, in ``ORDERS`` orders. Where both are
    one, the node is on that one's cycle, if on any, and is done. Nodes of one cycle have the same
    labels, so edges between others are taken out too, and what is left is labelled anew, in other
    orders. Orders are random, so rounds are as many as the logarithm of the nodes, whatever their
    names and however many cycles lie behind each other. Null ends are no edges.
    """
    links = _links(edges, child, parent)
    itself = links.where(F.col("child") == F.col("parent")).select(F.col("child").alias("node"), F.col("child").alias("label"))
    links, rows = _trimmed(links.where(F.col("child") != F.col("parent")))
    if not rows:
        return itself.select(F.col("node").alias(node), F.col("label").alias("cycle_id"))
    nodes, numbered = _numbered(links)
    drop_tables(links)
    links, parts, random = numbered, [], Random(0)
    while rows:
        masks = [random.getrandbits(64) - (1 << 63) for _ in range(ORDERS)]
        labels = _labelled(links, masks)
        same = [F.when(F.col(f"from_{i}") == F.col(f"to_{i}"), F.col(f"from_{i}").bitwiseXOR(F.lit(mask))) for i, mask in enumerate(masks)]
        done = labels.select(F.col("node").alias("number"), F.coalesce(*same).alias("first")).where("first IS NOT NULL")
        parts.append(materialize(done, "parts")[0])
        open_nodes = labels.where(F.coalesce(*same).isNull())
        pair = F.struct(*[c for c in labels.columns if c != "node"])
        for end in ("child", "parent"):
            links = links.join(open_nodes.select(F.col("node").alias(end), pair.alias(f"of_{end}")), end)
        left, rows = _trimmed(links.where("of_child = of_parent").select("child", "parent"))
        drop_tables(labels, numbered)
        links = numbered = left
    members = reduce(DataFrame.union, parts).join(nodes, "number").select("first", "node")
    # One that has no other with it is on no cycle.
    least = members.groupBy("first").agg(F.min("node").alias("label"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = itself.union(members.join(least, "first").select("node", "label"))
    return found.groupBy(F.col("node").alias(node)).agg(F.min("label").alias("cycle_id"))
