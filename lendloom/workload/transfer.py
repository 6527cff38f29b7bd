"""Files and request text."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.operators import encode
from lendloom.session import scratch_dir
from lendloom.sources import files
from lendloom.sources.split_csv import read_csv_split
from lendloom.workload.encoding import LABEL_COLUMNS, RARE_STATE, label_frame
from lendloom.workload.registry import query, table

DOCUMENT_SCHEMA = "doc_id bigint, text string, source string"


@query("csv_round_trip", "SELECT doc_id, md5(text) AS digest, source FROM documents")
def csv_round_trip(spark, folder):
    """Texts with quotes, commas and line breaks come back unchanged."""
    path = scratch_dir(spark, "csv")
    files.write_csv(table(spark, folder, "documents").select("doc_id", "text", "source"), path)
    return files.read_csv(spark, path, DOCUMENT_SCHEMA).select("doc_id", F.md5("text").alias("digest"), "source")


@query("csv_multiline_split", "SELECT doc_id, md5(text) AS digest, source FROM documents")
def csv_multiline_split(spark, folder):
    """The same texts through the reader whose tasks share files."""
    path = scratch_dir(spark, "csv")
    files.write_csv(table(spark, folder, "documents").select("doc_id", "text", "source"), path)
    return read_csv_split(spark, path, DOCUMENT_SCHEMA).select("doc_id", F.md5("text").alias("digest"), "source")


@query(
    "csv_append",
    "SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1",
)
def csv_append(spark, folder):
    path = scratch_dir(spark, "csv")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    for half in (0, 1):
        files.write_csv(orders.where(F.col("o_orderkey") % 2 == half), path, mode="append")
    back = files.read_csv(spark, path, "o_orderkey bigint, o_orderstatus string", multi_line=False)
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("state_round_trip", RARE_STATE)
def state_round_trip(spark, folder):
    path = scratch_dir(spark, "state")
    files.save_state(encode.fit_rare(label_frame(spark, folder), LABEL_COLUMNS), path)
    return files.load_state(spark, path).where("label IS NOT NULL").select("feature", "label", "replacement")


JSON_SQL = """
SELECT o_orderkey, '{"customer":[' || o_custkey || '],"note":["said \\"' || o_orderpriority || '\\""],"when":["' || strftime(o_orderdate, '%m/%d/%Y, %H:%M:%S')
  || CASE WHEN hour(o_orderdate) < 12 THEN 'AM' ELSE 'PM' END || '"],"share":[' || CASE WHEN o_orderkey % 3 = 0 THEN '0.5' ELSE 'null' END || ']}' AS json
FROM orders
"""


def request_texts(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), F.concat(F.lit('said "'), "o_orderpriority", F.lit('"')).alias("note"),
        F.col("o_orderdate").alias("when"),
        F.when(F.col("o_orderkey") % 3 == 0, 0.5).when(F.col("o_orderkey") % 3 == 1, F.lit(float("nan"))).alias("share"),
    )
    return files.request_json(orders, ["customer", "note", "when", "share"]).select("o_orderkey", "json")


@query("request_json", JSON_SQL)
def request_json(spark, folder):
    return request_texts(spark, folder)


@query(
    "request_rows",
    """
SELECT o_orderkey, o_custkey AS customer, 'said "' || o_orderpriority || '"' AS note, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0.5 END AS DOUBLE) AS share FROM orders
""",
)
def request_rows(spark, folder):
    columns = {"customer": "bigint", "note": "string", "share": "double"}
    return files.request_rows(request_texts(spark, folder), "json", columns, keep=["o_orderkey"])


@query(
    "request_rejects",
    """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'malformed' WHEN 1 THEN 'uneven' ELSE 'empty' END AS reason FROM orders WHERE o_orderkey % 4 < 3
""",
)
def request_rejects(spark, folder):
    """Requests that were cut short, have lists of unequal length, or hold nothing come back with their ids."""
    row = F.col("o_orderkey") % 4
    texts = request_texts(spark, folder).select(
        "o_orderkey",
        F.when(row == 0, F.expr("substring(json, 1, 20)")).when(row == 1, F.regexp_replace("json", r'"customer":\[', '"customer":[7,')).when(row == 2, F.lit("{}")).otherwise(F.col("json")).alias("json"),
    )
    columns = {"customer": "bigint", "note": "string", "share": "double"}
    return files.request_rejects(texts, "json", columns, keep=["o_orderkey"]).select("o_orderkey", "reason")
