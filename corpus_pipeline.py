"""The corpus pipeline: language ID, line dedup, near duplicates, decontamination, packing; and all queries of the ``llm`` package.

Every stage takes (spark, docs, sf_dir) and works on all rows it gets; all but the last return the columns of documents. Rows
with a null id are kept by the near-duplicate stage, since nothing can be linked to them; of rows that repeat an id one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.llm.common import batches_of, read, written
from lendloom.llm.decontaminate import contamination
from lendloom.llm.jaccard_join import jaccard_components, only
from lendloom.llm.language_id import classify, fit
from lendloom.llm.line_dedup import dedup_lines
from lendloom.llm.packing import pack, pieces, public_tokenizer
from lendloom.llm.queries import ORACLES, QUERIES, query


#: Rows passed to Python at once: whole texts, so that a worker and its executor hold a few megabytes of them.
ROWS_AT_ONCE = 500
#: Copies of the texts stay on disk until the last stage has read them, so they are packed tighter than by default.
TEXT_COMPRESSION = "zstd"


def in_small_batches(docs: DataFrame, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` gives, worked out here and kept, with few rows passed to Python at once."""
    with batches_of(docs.sparkSession, ROWS_AT_ONCE):
        return written(build(), name, TEXT_COMPRESSION)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; what is rejected goes."""
    return in_small_batches(docs, lambda: classify(docs, fit(docs)).where(~F.col("rejected")).select(*docs.columns), "known")


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share are taken out; n_chars follows the text."""
    fresh = lambda: dedup_lines(docs, min_docs=10, min_chars=1).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
    return in_small_batches(docs, fresh, "fresh")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, 0.8), the document with the smallest id."""
    found = written(jaccard_components(docs, size=5, percent=80).select("doc_id", "component_id"), "components")
    others = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = only(docs, others, "doc_id", "left_anti")
    again = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept.select(*docs.columns)
    repeated = only(kept, again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return only(kept, again, "doc_id", "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark passage."""
    found = lambda: contamination(docs, read(spark, sf_dir, "benchmark"), size=13, one_in=20)
    return in_small_batches(docs, lambda: found().where(~F.col("contaminated")).select(*docs.columns), "clean")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences of at most 2048 tokens."""
    with batches_of(spark, ROWS_AT_ONCE):
        return pack(pieces(docs, public_tokenizer("word_bpe_49k.json"), capacity=2048), capacity=2048)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", fresh_lines),
    ("jaccard_join", one_of_each),
    ("decontamination", decontaminated),
    ("packing", packed),
]
#: Stages whose result is a written copy already.
WRITTEN = {known_language, fresh_lines, decontaminated}
#: Compression sizes and byte-pair tokens have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        if stage not in WRITTEN:
            docs = written(docs, f"stage-{name}", TEXT_COMPRESSION)
    return STAGES[-1][1](spark, docs, sf_dir)


__all__ = ["ORACLES", "ORACLE_SQL", "QUERIES", "STAGES", "run"]
