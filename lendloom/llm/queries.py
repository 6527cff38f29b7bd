"""The registered queries of this package and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.llm.common import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SPACED_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x20\\x09-\\x0D]+')"
CONTAMINATION_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {ALNUM_SQL} AS ws FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS win, least(len(ws), 13) AS n
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT doc_id, {ALNUM_SQL} AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(ws) >= n)),
hits AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id"""
JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {SPACED_SQL} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 5, 0) + 2)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id"""
VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.x = e.vec_id LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) l ON l.x = e.vec_id"""

LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, place, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT lines.*, repeated.k IS NOT NULL AS gone FROM lines LEFT JOIN repeated ON lines.k = repeated.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op9_line_dedup", LINE_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.line_dedup import dedup_lines

    docs = read(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query("op5_decontamination", CONTAMINATION_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.decontaminate import contamination

    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, read(spark, folder, "benchmark"), size=13, one_in=20)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op8_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.packing import pack, pieces, public_tokenizer

    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pack(pieces(docs, public_tokenizer("word_bpe_49k.json"), capacity=2048), capacity=2048)


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.language_id import classify, fit, held_out

    docs = read(spark, folder, "documents")
    out = held_out("doc_id", 4, 2)
    dictionaries = fit(docs.where(~out))
    found = classify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || replace(role, ':', '\:') || ': ' || replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') || ' </turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op10_chat_formatting", CHAT_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.chat import digests, format_conversations

    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    return digests(format_conversations(rows.unionByName(probe.select(*(F.col(f.name).cast(f.dataType) for f in rows.schema)))))


WARC_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest"""


@query("op6_warc", WARC_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.warc import round_trip

    back = round_trip(read(spark, folder, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_html_text")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.html_text import extract

    return extract(read(spark, folder, "pages").select("page_id", "url", "html"))


@query("op3_jaccard_join", JACCARD_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.jaccard_join import jaccard_components

    return jaccard_components(read(spark, folder, "documents").select("doc_id", "text"), size=5, percent=80)


@query("op2_suffix_tree")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.language_id import held_out
    from lendloom.llm.suffix_tree import score

    return score(read(spark, folder, "documents").select("doc_id", "text", held_out("doc_id", 5, 1).alias("held_out")))


@query("op4_nn_descent", VECTOR_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.nn_descent import near_duplicates

    return near_duplicates(read(spark, folder, "embeddings").select("vec_id", "embedding"), threshold=0.9)


@query("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.packing import public_tokenizer
    from lendloom.llm.token_alignment import align

    return align(read(spark, folder, "documents").select("doc_id", "text"), public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model"))


def _nearest_sql(book: str) -> str:
    """Parts with the number distance * 64 + index of their nearest entry, the lower index in a tie."""
    return f"""(SELECT vec_id, pos, any_value(x) AS x, min(64 * list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + entry) AS m
  FROM p JOIN {book} USING (pos) GROUP BY vec_id, pos)"""


def _moved_sql(book: str, found: str) -> str:
    """The codebook with every used entry replaced by the floored mean of its parts."""
    return f"""(SELECT pos, entry, coalesce(means.c, {book}.c) AS c FROM {book} LEFT JOIN
  (SELECT pos, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY j) AS c FROM
    (SELECT pos, entry, j, sum(x[j]) AS total, count(*) AS n FROM (SELECT pos, m % 64 AS entry, x, unnest(range(1, len(x) + 1)) AS j FROM {found}) GROUP BY pos, entry, j)
  GROUP BY pos, entry) means USING (pos, entry))"""


CODES_SQL = f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, pos, e[pos * len(e) // 16 + 1:(pos + 1) * len(e) // 16] AS x FROM (SELECT vec_id, e, unnest(range(16)) AS pos FROM v)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT 64),
b0 AS MATERIALIZED (SELECT pos, entry, x AS c FROM p JOIN firsts USING (vec_id)),
a1 AS MATERIALIZED {_nearest_sql("b0")}, b1 AS MATERIALIZED {_moved_sql("b0", "a1")},
a2 AS MATERIALIZED {_nearest_sql("b1")}, b2 AS MATERIALIZED {_moved_sql("b1", "a2")},
a3 AS MATERIALIZED {_nearest_sql("b2")},
coded AS (SELECT vec_id, string_agg(printf('%02x', m % 64), '' ORDER BY pos) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a3 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(CAST(c[j] AS VARCHAR), ',' ORDER BY pos, entry, j)) AS codebooks_sha256 FROM (SELECT pos, entry, c, unnest(range(1, len(c) + 1)) AS j FROM b2))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN v USING (vec_id) CROSS JOIN book"""


@query("op12_vector_codes", CODES_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.vector_codes import codebook_digest, compress, with_label_error

    codes, books = compress(read(spark, folder, "embeddings").select("vec_id", "embedding", "label"), label="label")
    digest = F.lit(None if books is None else codebook_digest(books)).cast("string")
    return with_label_error(codes, "label").select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


@query("op13_private_spans")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from lendloom.llm.pii import find_private, fit

    docs = read(spark, folder, "documents").select("doc_id", "text")
    return find_private(docs, fit(docs))
