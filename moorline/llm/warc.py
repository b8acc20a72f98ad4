"""WARC archives of pages, and reading them back by boundary-chain verification (operator 1).

Writing: a page becomes one record. Of records with the same payload, from a least size on, one
is the response and the others are revisits that refer to it.

Reading: tasks cut the archives at every version line, in parallel and wherever the file splits
fall. Each piece may start a record, whose header tells where the next one starts. Pointer
jumping from the start of each file keeps the pieces that this chain reaches; a version line
inside a payload is never reached, and its piece goes back to the record that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch
from moorline.session import scratch_path

# Fixed values of the public archive format.
VERSION = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"

CANDIDATE = "file string, block long, at long, size long, next long, whole boolean, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, digest_ok boolean"
RECORD = CANDIDATE.partition("whole boolean, ")[2]


def _field(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, least: int = LEAST_REVISIT, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One column ``record``: a record per row of ``pages``, without the blank lines after it.

    The payload is the html in UTF-8, empty for null. Of records with equal payloads of
    ``least`` bytes or more the one with the largest key is the response. A row without a key
    has an id without a number and can't be that one. Line ends in a url are left out, a null
    url has no line. Rows that repeat key and payload are responses alike if one of them is.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.regexp_replace(F.col(url).cast("string"), "[\r\n]", "").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload"), "digest": F.sha1(F.col("payload").cast("binary"))})
    firsts = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("id").alias("first"))
    found = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(VERSION), _field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _urn(F.col("id"))), _field("WARC-Date", DATE),
        F.coalesce(_field("WARC-Target-URI", F.col("url")), F.lit("")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, F.concat(_field("WARC-Profile", PROFILE), _field("WARC-Refers-To", _urn(F.col("first"))))).otherwise(F.lit("")),
        _field("Content-Type", "application/http; msgtype=response"), _field("Content-Length", F.octet_length("body").cast("string")),
        F.lit("\r\n"),
    )
    return found.withColumn("body", body).select(F.concat(head, F.col("body")).alias("record"))


def write_archives(pages: DataFrame, path: str, codec: str = "gzip", **options) -> None:
    """Write :func:`records` as archive files under ``path``, each record with two line ends behind it."""
    records(pages, **options).write.option("lineSep", "\r\n\r\n").option("compression", codec).text(path)


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def parse(piece: bytes) -> tuple[int, int, dict] | None:
    """Header bytes, content bytes and fields of what follows a version line; None if no record."""
    head, end, _ = piece.partition(b"\r\n\r\n")
    if not end:
        return None
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return len(head) + 4, int(fields["content-length"]), fields


def record_values(fields: dict, content: bytes) -> tuple:
    """Page, payload bytes and digest, type, reference, and whether the digest is that of the payload.

    A revisit has no payload; its digest is held against its response later.
    """
    http, _, payload = content.partition(b"\r\n\r\n")
    named = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        sizes = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        size, digest = int(sizes[0]) if sizes else 0, named
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return _number(fields.get("warc-record-id")), size, digest, fields["warc-type"], _number(fields.get("warc-refers-to")), digest == named


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """File, block, place within the block's pieces, and bytes of each piece; rows come in file order."""
    here, at = None, 0
    for batch in batches:
        for value, file, block in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if (file, block) != here:
                here, at = (file, block), 0
            data = value.as_py()
            yield file, block, at, data
            at += len(data) + len(VERSION)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every piece, with the way to its successor if it may start a record."""
    schema, rows = _arrow(CANDIDATE), []
    for file, block, at, data in _pieces(batches):
        found = parse(data)
        values, reach, whole = (None,) * 6, None, False
        if found:
            head, size, fields = found
            # Over the version line, the record and the two line ends behind it.
            reach = head + size + 4
            whole = len(data) >= head + size
            if whole:
                values = record_values(fields, data[head:head + size])
        rows.append((file, block, at, len(data), reach, whole, *values))
        if len(rows) >= 4096:
            yield _batch(rows, schema)
            rows = []
    yield _batch(rows, schema)


def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow("file string, block long, at long, data binary")
    for row in _pieces(batches):
        yield _batch([row], schema)


def reassembled(key: tuple, group: pa.Table) -> pa.Table:
    """A record whose payload holds version lines, from its pieces in order."""
    rows = sorted(zip(group["start"].to_pylist(), group["data"].to_pylist()))
    data = VERSION.encode().join(data for _, data in rows)
    head, size, fields = parse(data)
    return pa.table([[v] for v in record_values(fields, data[head:head + size])], schema=_arrow(RECORD))


def reachable(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """``(file, start)`` of the pieces on the chain from each file's start, by pointer jumping.

    After round k every piece knows its 2^k-th successor, and all pieces up to 2^k steps from the
    start are marked, so a file of n records takes log2(n) rounds.
    """
    known = scratch.save(pieces.where("next IS NOT NULL").select("file", "start", "next", (F.col("start") == 0).alias("marked")))
    while True:
        ahead = known.select("file", F.col("start").alias("next"), F.col("next").alias("further"))
        told = known.where("marked").select("file", F.col("next").alias("start"), F.lit(True).alias("told")).distinct()
        stepped = scratch.save(
            known.join(told, ["file", "start"], "left").join(ahead, ["file", "next"], "left")
            .select("file", "start", F.col("further").alias("next"), (F.col("marked") | F.coalesce("told", F.lit(False))).alias("marked"),
                    (~F.col("marked") & F.coalesce("told", F.lit(False))).alias("fresh"))
        )
        scratch.drop(known)
        known = stepped
        if not known.where("fresh").limit(1).count():
            return known.where("marked").select("file", "start")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok)`` per record under ``path``.

    ``payload_bytes`` and ``payload_digest`` are of the full payload: counted and hashed for a
    response, as written for a revisit. ``digest_ok`` says that the written digest is the one
    found; for a revisit, that the response it refers to was read and has this digest and length. Bytes that no chain from a file's start reaches are no records; an empty folder has
    none.
    """
    scratch = Scratch(spark, "warc")
    lines = spark.read.schema("value string").option("lineSep", VERSION).text(path)
    raw = lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    cut = scratch.save(raw.mapInArrow(candidates, CANDIDATE))
    # A block's pieces start where those of the blocks before it end.
    sizes = cut.groupBy("file", "block").agg(F.sum(F.col("size") + len(VERSION)).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    start = F.col("base") + F.col("at") - len(VERSION)
    pieces = scratch.save(
        cut.join(bases, ["file", "block"]).withColumn("start", start)
        .withColumn("next", F.when(start >= 0, start + len(VERSION) + F.col("next"))).drop("base", "size")
    )
    scratch.drop(cut)
    chain = reachable(pieces, scratch).withColumn("reached", F.lit(True))
    marked = pieces.join(chain, ["file", "start"], "left")
    values = [part.split()[0] for part in RECORD.split(", ")]
    whole = marked.where("reached AND whole").select(*values)

    broken = marked.where("reached AND NOT whole").select("file").distinct()
    place = Window.partitionBy("file").orderBy("start")
    owned = (
        marked.join(broken, "file", "left_semi").where("start >= 0")
        .select("file", "block", "at", "start", F.last(F.when(F.col("reached"), F.col("start")), True).over(place).alias("owner"),
                F.last(F.when(F.col("reached"), F.col("whole")), True).over(place).alias("owner_whole"))
        .where("NOT owner_whole")
    )
    rebuilt = (
        raw.mapInArrow(contents, "file string, block long, at long, data binary").join(owned, ["file", "block", "at"])
        .groupBy("file", "owner").applyInArrow(reassembled, RECORD)
    )
    return _with_references(scratch.save(whole.union(rebuilt)))


def _with_references(records: DataFrame) -> DataFrame:
    """``records`` with ``digest_ok`` of revisits: whether the response they name is there, with their length and digest."""
    same = ["refers_to", "payload_digest", "payload_bytes"]
    responses = records.where("record_type = 'response' AND digest_ok").select(F.col("page_id").alias("refers_to"), *same[1:]).distinct()
    again = records.where("record_type = 'revisit'").join(responses.withColumn("there", F.lit(True)), same, "left")
    again = again.withColumn("digest_ok", F.coalesce("there", F.lit(False))).select(records.columns)
    return records.where("record_type <> 'revisit'").union(again)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "archives")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
