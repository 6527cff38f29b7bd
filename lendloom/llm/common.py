"""Shared helpers: reading, Arrow slices, word hashes, and links to components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.operators.skew import enrich, hot_keys
from lendloom.session import checkpointed, scratch_dir

SLICE_BYTES = 1 << 21
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder. Workers on this machine find the package where the driver did; a cluster gets it with --py-files."""
    here, environment = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if here not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, environment.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Keep a frame as Parquet in the shared folder and read it again: lineage ends there, and lost tasks reread files."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def batches_of(spark: SparkSession, rows: int):
    """Jobs that run inside pass rows to Python in batches of so many: for rows of many kilobytes."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a job that runs inside go when it ends: for operators that keep what they need in written tables."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@functools.cache
def _trim():
    """What hands freed memory of the C library back, where there is such a call."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def freed(step):
    """A step over batches that gives its freed memory back when its task ends: Python workers live on and wait, and an
    executor holds all of them."""

    @functools.wraps(step)
    def run(batches):
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return run


def freed_once(step):
    """The same for a step on whole groups: after each of them."""

    @functools.wraps(step)
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return step(left, right)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return run


def gathered(batches) -> pa.Table | None:
    """All batches of a partition as one table; None if there are no rows."""
    batches = list(batches)
    table = pa.Table.from_batches(batches) if batches else None
    return table if table is not None and table.num_rows else None


def partitions_of(df: DataFrame) -> int:
    """Partitions of a scan: they follow the size of the input."""
    return max(1, df.rdd.getNumPartitions())


# ---------------------------------------------------------------- numbers as bytes

def planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then their second bytes, and so on: sorted or small numbers have planes of few different
    bytes, which the compression of shuffles and files takes out."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def of_planes(parts, kind) -> np.ndarray:
    """The numbers of several such byte strings, end to end."""
    width = np.dtype(kind).itemsize
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, np.uint8).reshape(width, -1).T.copy().view(kind)[:, 0] for x in parts)])


# ---------------------------------------------------------------- texts as bytes

def table_of(in_word) -> np.ndarray:
    return np.array([in_word(b) for b in range(256)], dtype=bool)


SPACED = table_of(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALNUM = table_of(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
LOWER_TABLE = LOWER.tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and the offset of each row (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(bounds):
        bounds = np.zeros(1, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``most`` bytes: first row, row after the last, bytes, offsets. A longer text is a run of its own."""
    data, bounds = utf8(column)
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + most, "right")) - 1)
        yield low, high, data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low]
        low = high


_RANDOM = np.random.default_rng(20240611)
_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray, in_word: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of several texts, and where each text's words begin.

    A word's hash is a polynomial over its bytes, read off running sums, so the cost is a few passes over the bytes.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    low = LOWER[data]
    word = in_word[low]
    before = np.empty(len(word), bool)
    before[0] = False
    before[1:] = word[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(word)]
    before[cuts] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(len(word), bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(word & ~after)
    up, down = _powers(len(data))
    sums = np.cumsum(_VALUE[low] * up, dtype=np.uint64)
    upto = sums[starts] - _VALUE[low[starts]] * up[starts]
    hashes = mix((sums[ends] - upto) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, begins: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; a text of fewer words is one shingle, one without words has none."""
    if len(words) >= size:
        grams = np.zeros(len(words) - size + 1, np.uint64)
        for j in range(size):
            grams = grams * np.uint64(_BASE) + words[j:len(words) - size + 1 + j]
        grams = mix(grams)
    else:
        grams = np.zeros(0, np.uint64)
    sets = []
    for low, high in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if high - low >= size:
            sets.append(np.unique(grams[low:high - size + 1]))
        elif high > low:
            short = np.full(1, high - low, np.uint64)
            for at in range(low, high):
                short = mix(short * np.uint64(_BASE) + words[at:at + 1])
            sets.append(short)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


# ---------------------------------------------------------------- components

def _local_forest(batches):
    """Links of one partition replaced by (node, smallest reachable node): never more rows than nodes."""
    import pandas as pd

    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    for frame in batches:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in list(parent) if root(x) != x]
    yield pd.DataFrame({"a": np.array(nodes, np.int64), "b": np.array([root(x) for x in nodes], np.int64)})


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of links (a, b); a component is named after its smallest node.

    Partitions are first reduced to forests; then large-star and small-star steps alternate until nothing changes,
    each an aggregation with a map-side part and a join. Every step ends in a checkpoint.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.col("a").cast("long"), F.col("b").cast("long"))
    edges = checkpointed(edges.mapInPandas(freed(_local_forest), "a long, b long"))
    seen = None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # A component's root may own most links: they are dealt over as many tasks as their number asks for.
        large = enrich(both.where("b > a"), least, "a", "inner", hot=hot_keys(both, "a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionAll(
            down.select("a", F.col("m").alias("b"))).distinct()
        edges = checkpointed(small)
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
