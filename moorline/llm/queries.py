"""The numbered queries, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorline.llm import language_id
from moorline.llm.decontamination import contamination
from moorline.llm.exact_dedup import exact_duplicates
from moorline.llm.hard_negatives import hard_negatives
from moorline.llm.license_scan import NOTICES, license_scan, license_texts, notices
from moorline.llm.line_dedup import spread_dedup
from moorline.llm.longest_match import token_counts
from moorline.llm.near_duplicates import near_duplicates
from moorline.llm.pieces import encode
from moorline.llm.prefix_trie import prefix_trie
from moorline.llm.toxicity import fit, toxicity
from moorline.llm.vector_search import nearest
from moorline.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def numbered(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@numbered
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "pages"))


ORACLES["op1_warc"] = """
WITH rows AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, max(page_id) AS first FROM rows WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, true AS digest_ok
FROM rows LEFT JOIN firsts USING (payload_digest)
"""


@numbered
def op2_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    found = spread_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_removed", F.sha2("text", 256).alias("text_sha256"))


ORACLES["op2_line_spread"] = """
WITH lines AS (
    SELECT doc_id, source, n, line, nullif(trim(line, ' ' || chr(9) || chr(13)), '') AS own
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
), wide AS (
    SELECT own, min(doc_id) AS keeper FROM lines WHERE own IS NOT NULL
    GROUP BY own HAVING count(DISTINCT source) >= 10
), kept AS (
    SELECT l.doc_id, l.n, l.line, w.own IS NULL OR l.doc_id = w.keeper AS stays
    FROM lines l LEFT JOIN wide w ON l.own = w.own
), cut AS (
    SELECT doc_id, count(*) FILTER (NOT stays) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (stays), '') AS text
    FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_removed, 0) AS n_removed, sha256(coalesce(c.text, d.text)) AS text_sha256
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""


@numbered
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity(docs, fit(docs, table(spark, folder, "labels")))


@numbered
def op4_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), "vec_id % 50 = 0")


ORACLES["op4_vector_search"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@numbered
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), num=85)


ORACLES["op5_minhash_near_dedup"] = """
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)
), sets AS (
    SELECT doc_id, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS own FROM shingles GROUP BY doc_id
), firsts AS (
    SELECT own, min(doc_id) AS rep, any_value(n) AS n FROM sets GROUP BY own
), parts AS (
    SELECT rep, n, shingle FROM firsts JOIN shingles ON doc_id = rep
), shared AS (
    SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b, count(*) AS common
    FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.rep <> b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.rep, b.rep
), links AS (
    SELECT a, b FROM shared WHERE 100 * common >= 85 * (n_a + n_b - common)
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least_of AS (
    SELECT rep, least(rep, min(b)) AS label FROM firsts LEFT JOIN reach ON a = rep GROUP BY rep
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(label, doc_id) AS component_id, coalesce(label, doc_id) = doc_id AS kept
FROM texts LEFT JOIN (SELECT doc_id, n, rep FROM sets JOIN firsts USING (own, n)) USING (doc_id) LEFT JOIN least_of USING (rep)
"""


@numbered
def op6_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents").select("doc_id", "text"), digest=True)


@numbered
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.language_id(docs, language_id.fit(docs))


@numbered
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("spans")


ORACLES["op8_benchmark_decontamination"] = """
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark
), wanted AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS body
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), windows AS (
    SELECT doc_id, i, width, array_to_string(w[i:i + width - 1], ' ') AS body
    FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM texts, (SELECT DISTINCT width FROM wanted) WHERE len(w) >= width)
), hits AS (
    SELECT doc_id, i, width, item_id FROM windows JOIN wanted USING (width, body)
), places AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS place FROM (SELECT DISTINCT doc_id, i, width FROM hits)) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT t.doc_id, len(w) AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(p.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN places p ON p.doc_id = t.doc_id LEFT JOIN found f ON f.doc_id = t.doc_id
"""


@numbered
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"), notices(spark).union(license_texts(spark)))


# The SQL has the short notices only; the given documents hold no other licence text.
ORACLES["op9_license_scan"] = """
WITH templates(license_id, text) AS (VALUES %s),
split AS (
    SELECT license_id, list_filter(string_split_regex(lower(text), '[^a-z0-9\\x{80}-\\x{10FFFF}]+'), lambda x: x <> '') AS w FROM templates
), parts AS (
    SELECT license_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS shingle
    FROM (SELECT license_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), known AS (SELECT DISTINCT license_id, shingle FROM parts),
sizes AS (SELECT license_id, count(*) AS n_shingles FROM known GROUP BY license_id),
stride AS (SELECT max(i) + 2 AS stride FROM parts),
texts AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9\\x{80}-\\x{10FFFF}]+'), lambda x: x <> '') AS w FROM documents
), hits AS (
    SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts)
    WHERE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] IN (SELECT shingle FROM known)
), windows AS (
    SELECT doc_id, pos // stride - back AS win, pos, shingle FROM hits, stride, (VALUES (0), (1)) AS b(back)
), shared AS (
    SELECT doc_id, win, license_id, count(DISTINCT w.shingle) AS shared, min(pos) AS first_word
    FROM windows w JOIN known k ON w.shingle = k.shingle GROUP BY doc_id, win, license_id
), ranked AS (
    SELECT doc_id, license_id, shared, n_shingles, first_word,
           row_number() OVER (PARTITION BY doc_id, license_id ORDER BY shared DESC, first_word) AS place
    FROM shared JOIN sizes USING (license_id) WHERE shared * 20 >= n_shingles * 19
)
SELECT doc_id, license_id, shared, n_shingles, CAST(first_word AS BIGINT) AS first_word FROM ranked WHERE place = 1
""" % ", ".join("('%s', '%s')" % pair for pair in NOTICES)


@numbered
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))


@numbered
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefix_trie(table(spark, folder, "conversations"), conv - conv % 5, head, most_head=8)


# The first list is the table of the checksum, made from its polynomial.
ORACLES["op11_prefix_trie"] = """
WITH crc AS (
    SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY n) AS t FROM range(256) AS r(n)
), ordered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM ordered), crc
), heads AS (
    SELECT c.conv_id, o.pos AS d, role, text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.pos <= h
), taken AS (
    SELECT conv_id, h, coalesce(n, 0) AS n FROM convs LEFT JOIN (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id) USING (conv_id)
), rebuilt AS (
    SELECT * FROM heads UNION ALL SELECT conv_id, pos - h + n, role, text FROM ordered JOIN taken USING (conv_id) WHERE pos > h
), paths AS (
    SELECT conv_id, d, strlen(text) AS bytes, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
    SELECT path, left(path, length(path) - 128) AS parent, any_value(d) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs
    FROM paths GROUP BY path
), children AS (
    SELECT parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), whole AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), sums AS (
    SELECT p.path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * u.bytes) AS saved_tokens
    FROM whole u JOIN paths p ON p.conv_id = u.conv_id AND p.d <= u.depth GROUP BY p.path
), ends AS (
    SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, path FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY d DESC) = 1) GROUP BY path
)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM whole w JOIN sums USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes p ON p.path = w.parent AND w.depth > 0
"""


@numbered
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), "vec_id % 100 = 0")


ORACLES["op12_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER nearest AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW nearest AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER nearest <= 5
"""


@numbered
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


ORACLES["op13_exact_dedup"] = """
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS normal FROM documents
), groups AS (
    SELECT normal, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256 FROM texts JOIN groups USING (normal)
"""
