"""Scoring over a stream of request files. Each row is scored on its own, so no state or watermark is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lendloom.plans.scoring import Scorer, score
from lendloom.sources.files import request_rejects, request_rows


def read_requests(spark: SparkSession, folder: str, columns: dict[str, str], files_per_trigger: int = 1000) -> DataFrame:
    """Stream of rows from files with one request object per line."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return request_rows(lines, "value", columns)


def read_rejects(spark: SparkSession, folder: str, columns: dict[str, str], files_per_trigger: int = 1000) -> DataFrame:
    """Stream of the request lines that cannot be scored, with the reason: for a sink of its own beside the scores."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return request_rejects(lines, "value", columns)


def deliver(
    spark: SparkSession, requests: str, columns: dict[str, str], scorer: Scorer, key: str, as_of: Column, scores: str, rejects: str, checkpoint: str,
    files_per_trigger: int = 1000, available_now: bool = True,
) -> StreamingQuery:
    """Scores and rejects of one read: every request line reaches exactly one of two Parquet folders, exactly once.

    A batch is read once and kept while both sinks are written. Each sink holds a folder per batch number, which a batch that is run
    again after a failure replaces; so a half-written batch leaves neither a gap nor a second copy. Read the sinks with ``delivered``.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(requests)

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            score(request_rows(kept, "value", columns), scorer, key, as_of).write.mode("overwrite").parquet(f"{scores}/batch={number}")
            request_rejects(kept, "value", columns).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        finally:
            kept.unpersist()

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """What a sink of ``deliver`` holds, with the number of the batch."""
    return spark.read.parquet(folder)


def score_stream(requests: DataFrame, scorer: Scorer, key: str, as_of: Column) -> DataFrame:
    return score(requests, scorer, key, as_of)


def write_scores(scored: DataFrame, folder: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append scores as Parquet, each request file exactly once."""
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(folder)
