"""Quoted CSV with line breaks inside fields, read in pieces: many tasks share one file.

A reader that cuts files at line breaks cannot know whether a break lies inside quotes. Here every block of a file is read by
lines, and the parity of its quotes is summed; a prefix scan over the blocks of a file, one row each, tells whether a block begins
inside a field. Blocks that begin outside and hold whole lines only are records as they stand. In the others a running parity
finds the lines at which records begin; a record of several lines is put together under the place of its first line, even
across blocks. So only lines of such blocks are shuffled, by block, and only records of several lines by record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.operators.skew import broadcast_if_small
from lendloom.session import checkpointed
from lendloom.sources.files import CSV_OPTIONS


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """(file, block, line, value, odd): lines in reading order within their block, and whether they hold an odd number of quotes."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return rows.withColumn("odd", (quotes % 2).cast("int"))


def csv_records(spark: SparkSession, path: str, header: bool = True, quote: str = '"') -> DataFrame:
    """(file, text): every record, as text; blank lines between records and the header of each file are left out."""
    lines = _lines(spark, path, quote)
    in_block, in_file = W.partitionBy("file", "block").orderBy("line"), W.partitionBy("file").orderBy("block")
    summary = lines.groupBy("file", "block").agg(F.sum("odd").alias("odds"), F.min("line").alias("first"))
    before = F.coalesce(F.sum("odds").over(in_file.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2
    blocks = broadcast_if_small(checkpointed(summary.withColumn("inside", before)))  # one row per block
    placed = lines.join(blocks, ["file", "block"])
    title = (F.col("block") == 0) & (F.col("line") == F.col("first")) if header else F.lit(False)
    ends = F.regexp_replace("text", "\r$", "")

    simple = placed.where((F.col("odds") == 0) & (F.col("inside") == 0) & ~title).select("file", F.col("value").alias("text"))
    mixed = placed.where((F.col("odds") > 0) | (F.col("inside") == 1))
    upto = F.col("inside") + F.sum("odd").over(in_block.rowsBetween(W.unboundedPreceding, W.currentRow))
    state = mixed.withColumn("ends_inside", upto % 2).withColumn("begins_inside", (upto - F.col("odd")) % 2)
    start = F.when(F.col("begins_inside") == 0, F.struct("block", "line", title.alias("title")))
    state = state.withColumn("start", F.last(start, ignorenulls=True).over(in_block.rowsBetween(W.unboundedPreceding, W.currentRow)))
    whole = state.where((F.col("begins_inside") == 0) & (F.col("ends_inside") == 0) & ~title).select("file", F.col("value").alias("text"))
    parts = checkpointed(state.where((F.col("begins_inside") == 1) | (F.col("ends_inside") == 1)).select("file", "block", "line", "value", "start"))
    # A block without a start of its own before its first lines goes on with the last start of the blocks before it.
    starts = parts.groupBy("file", "block").agg(F.max("start").alias("last"))
    carried = starts.withColumn("carried", F.last("last", ignorenulls=True).over(in_file.rowsBetween(W.unboundedPreceding, -1))).drop("last")
    owned = parts.join(broadcast_if_small(carried), ["file", "block"]).withColumn("start", F.coalesce("start", "carried")).where(~F.coalesce(F.col("start.title"), F.lit(False)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n")
    joined = owned.groupBy("file", "start").agg(text.alias("text")).select("file", "text")
    return simple.unionByName(whole).unionByName(joined).withColumn("text", ends).where("text <> ''")


def read_csv_split(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True) -> DataFrame:
    """The rows that ``read_csv`` gives with ``multi_line``, from as many tasks as the files have blocks; in no order.

    Columns are taken by position. A quote that is never closed ends with its file.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {k: str(v) for k, v in CSV_OPTIONS.items() if k != "header"} | {"multiLine": "true"}
    parsed = csv_records(spark, path, header, CSV_OPTIONS["quote"]).select(F.from_csv("text", _ddl(fields), options).alias("r"))
    return parsed.select("r.*")


def _ddl(fields: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
