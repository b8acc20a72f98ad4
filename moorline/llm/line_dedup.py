"""Line dedup by cross-site spread (operator 2).

Every line's hash gets a HyperLogLog sketch of the sites it was seen on; sketches merge by
aggregation, so a line on a third of all pages sends one row per task. Most estimates are far
from the threshold and decide at once; lines near it get exact distinct counts. A line on
enough sites is boilerplate: one document keeps it, all others lose it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch

LEAST_SITES = 10
# A line of more words is a passage.
PASSAGE_WORDS = 50
LOG_REGISTERS = 12
# Three standard errors of such a sketch, 1.04 / sqrt(2^12) each.
MARGIN = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)


def _line(line: F.Column) -> F.Column:
    """The line without blanks around it; null where nothing is left."""
    return F.nullif(F.btrim(line, F.lit(" \t\r")), F.lit(""))


def _lines(text: F.Column) -> F.Column:
    return F.split(text, "\n", -1)


def widespread_lines(hashed: DataFrame, least_sites: int, scratch: Scratch) -> DataFrame:
    """``(hi, lo, first)``: hashes of lines on ``least_sites`` sites or more, and the key that keeps each.

    ``hashed`` has ``id, site, hi, lo`` per line. Sketches decide where the estimate is further
    than the margin from the threshold, exact counts of distinct sites decide the others.
    """
    sites = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites")
    reach = max(1.0, least_sites * MARGIN)
    open_ = scratch.save(
        hashed.groupBy("hi", "lo").agg(sites, F.min("id").alias("first")).where(F.col("sites") >= least_sites - reach)
    )
    near = open_.where(F.col("sites") <= least_sites + reach).select("hi", "lo", "first")
    counted = (
        hashed.join(near, ["hi", "lo"]).select("hi", "lo", "first", "site").distinct()
        .groupBy("hi", "lo", "first").agg(F.count("site").alias("sites")).where(F.col("sites") >= least_sites)
    )
    return open_.where(F.col("sites") > least_sites + reach).select("hi", "lo", "first").union(counted.drop("sites"))


def spread_dedup(
    docs: DataFrame, least_sites: int = LEAST_SITES, key: str = "doc_id", site: str = "source", text: str = "text"
) -> DataFrame:
    """``docs`` with cross-site boilerplate lines cut from their texts, and ``n_removed`` lines each.

    Lines end at line feeds; blanks around them don't count, and blank lines are never cut. A
    line on ``least_sites`` different sites or more stays in the documents with the least key
    that has it, and goes from all others, wherever it stands in them. A null site counts for
    none. A row with a null key lends its lines to the counts but keeps its text. A null text
    stays null, an empty one empty. Rows that repeat a key are cut alike. A column of ``docs``
    named ``n_removed`` gives way.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    hashed = scratch.save(_hashed(docs, key, F.col(site).cast("string"), text))
    return _without(docs, hashed, scratch.save(widespread_lines(hashed, least_sites, scratch)), key, text)


def passage_dedup(docs: DataFrame, words: int = PASSAGE_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines of more than ``words`` words cut, and ``n_removed`` lines each.

    Such a line in two documents or more, on one site or many, stays in the one with the least
    key. Words are runs of other characters than white space. All else is as in
    :func:`spread_dedup`.
    """
    scratch = Scratch(docs.sparkSession, "passage-dedup")
    hashed = scratch.save(_hashed(docs, key, F.lit(None).cast("string"), text, words))
    ends = hashed.groupBy("hi", "lo").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    return _without(docs, hashed, scratch.save(ends.where("first <> last").select("hi", "lo", "first")), key, text)


def _hashed(docs: DataFrame, key: str, site: F.Column, text: str, words: int = 0) -> DataFrame:
    """``(id, site, hi, lo)`` of each line of more than ``words`` words."""
    rows = docs.select(F.col(key).alias("id"), site.alias("site"), F.explode(_lines(F.col(text))).alias("line"))
    line = _line(F.col("line"))
    rows = rows.where(line.isNotNull())
    if words:
        rows = rows.where(F.size(F.split(line, r"\s+", -1)) > words)
    return rows.select("id", "site", F.xxhash64(line).alias("hi"), F.xxhash64(F.lit(1), line).alias("lo"))


def _without(docs: DataFrame, hashed: DataFrame, wide: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` without the lines of ``wide``, but for the rows with the key that keeps them."""
    cuts = (
        hashed.where("id IS NOT NULL").join(wide, ["hi", "lo"]).where("id <> first")
        .groupBy("id").agg(F.collect_set("hi").alias("cut_lines"))
    )
    kept = F.filter(_lines(F.col("doc")[text]), lambda x: F.coalesce(~F.array_contains("cut_lines", F.xxhash64(_line(x))) | _line(x).isNull(), F.lit(True)))
    cut = F.col("cut_lines").isNotNull() & F.col("doc")[text].isNotNull()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("id"))
    found = own.join(cuts, "id", "left").withColumn("kept_lines", F.when(cut, kept))
    removed = F.when(cut, F.size(_lines(F.col("doc")[text])) - F.size("kept_lines")).otherwise(0)
    others = [c for c in docs.columns if c != "n_removed"]
    return found.select(
        *[F.when(cut, F.array_join("kept_lines", "\n")).otherwise(F.col("doc")[text]).alias(text) if c == text else F.col("doc")[c].alias(c) for c in others],
        removed.cast("long").alias("n_removed"),
    )
