"""CSV, JSON-lines and state files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}
JSON_DATE = "MM/dd/yyyy, HH:mm:ss"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV with quoted text that may hold quotes, commas and line breaks.

    Files with line breaks inside fields cannot be cut: each is one task. Without such
    fields turn ``multi_line`` off, so that large files are read in pieces.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``mode='append'`` adds files with the same columns; the header is in every file."""
    df.write.mode(mode).options(header=True, quote='"', escape='"').csv(path)


def save_state(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- requests ---------------------------------------------------------------------


def request_schema(columns: dict[str, str]) -> str:
    """Schema of an object of column -> list of values."""
    return ", ".join(f"`{name}` array<{kind}>" for name, kind in columns.items())


def _parsed(df: DataFrame, column: str, columns: dict[str, str], keep: Sequence[str]) -> DataFrame:
    schema = f"{request_schema(columns)}, `_bad` string"
    request = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": "_bad"})
    return df.select(*keep, F.col(column).alias("_text"), request.alias("_request"))


def request_rejects(df: DataFrame, column: str, columns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, text, reason) of requests that give no rows, or whose lists differ in length: malformed, empty, uneven."""
    parsed = _parsed(df, column, columns, keep)
    sizes = [F.size(F.coalesce(F.col(f"_request.{name}"), F.array())) for name in columns]
    longest, shortest = (F.greatest(*sizes), F.least(*sizes)) if len(sizes) > 1 else (sizes[0], sizes[0])
    reason = (
        F.when(F.col("_request").isNull() | F.col("_request._bad").isNotNull(), "malformed")
        .when(longest == 0, "empty").when(longest != shortest, "uneven")
    )
    return parsed.select(*keep, F.col("_text").alias("text"), reason.alias("reason")).where("reason IS NOT NULL")


def request_rows(df: DataFrame, column: str, columns: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per position of the lists in a request text; shorter lists are padded with NULL.

    A text that is no request gives no row here: ``request_rejects`` lists it.
    """
    parsed = _parsed(df, column, columns, keep).where(F.col("_request._bad").isNull())
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"_request.{name}"), F.array()).alias(name) for name in columns])
    return parsed.select(*keep, F.explode(zipped).alias("_row")).select(*keep, *[F.col(f"_row.{name}").alias(name) for name in columns])


def _json_value(name: str, kind: T.DataType) -> Column:
    column = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.concat(F.date_format(column, JSON_DATE), F.date_format(column, "a"))
    return column


def request_json(df: DataFrame, columns: Sequence[str], name: str = "json") -> DataFrame:
    """Add the request text of each row: ``{"column":[value],...}``, NaN as null, text escaped."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    lists = [F.array(_json_value(c, kinds[c])).alias(c) for c in columns]
    return df.withColumn(name, F.to_json(F.struct(*lists), {"ignoreNullFields": "false"}))
