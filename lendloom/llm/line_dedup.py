"""Drop lines that many documents share.

Two Bloom filters cover the keys of all lines: a key goes into the first when a document shows it, and into the second when
it was (or seemed to be) in the first already. Every task fills its own pair; pairs are merged segment by segment with
``twice = twice | twice' | (once & once')`` and ``once = once | once'``, so a key of two documents is always in the second.
Only keys that the second filter holds, the suspected repeats, are shuffled, as (key, documents) sums per task, and counted
exactly on their text. A filter that is too small only means more suspects.

Null or empty texts are one empty line. Keys shorter than ``min_chars`` are never counted. A repeated row counts as another
document. With ``first`` set, the first document (smallest id) that shows a repeated line keeps it.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import LOWER_TABLE, SPACES, freed, partitions_of, written

HASHES = 4
SEGMENTS = 32
BITS_PER_KEY = 10
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
BROADCAST_BYTES = 64 << 20


def keys_of(lines: list[bytes]) -> list[bytes]:
    return [line.strip(SPACES) for line in lines]


def _lines(value) -> list[bytes]:
    return (value or b"").split(b"\n")


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or sum(b & 0xC0 != 0x80 for b in key) >= least)


def _document_keys(text: bytes, least: int) -> set[bytes]:
    return {k for k in set(keys_of(_lines(text.translate(LOWER_TABLE)))) if _long_enough(k, least)}


def _texts(batch: pa.RecordBatch, column: str):
    for value in batch.column(column).cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py() or b""


def _places(keys: list[bytes], bits: int) -> np.ndarray:
    """HASHES bit numbers per key, from one 128-bit hash."""
    wide = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=np.uint64).reshape(-1, 2)
    step = np.arange(HASHES, dtype=np.uint64)[None, :]
    return (wide[:, :1] + step * (wide[:, 1:] | np.uint64(1))) % np.uint64(bits)


def _has(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _put(bitmap: np.ndarray, places: np.ndarray) -> None:
    places = places.ravel()
    np.bitwise_or.at(bitmap, places >> np.uint64(3), np.left_shift(np.uint8(1), (places & np.uint64(7)).astype(np.uint8)))


def _filters(docs: DataFrame, column: str, bits: int, least: int) -> DataFrame:
    def fill(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

        def add(keys):
            # A key may stand in ``keys`` several times: all but one go on to the second filter.
            places = _places(keys, bits)
            _, first = np.unique(places[:, 0] * np.uint64(31) + places[:, 1], return_index=True)
            again = np.ones(len(keys), bool)
            again[first] = False
            known = _has(once, places)
            _put(twice, places[known | again])
            _put(once, places[~known])

        held: list[bytes] = []
        for batch in batches:
            for text in _texts(batch, column):
                held.extend(_document_keys(text, least))
                if len(held) > 50_000:
                    add(held)
                    held = []
        if held:
            add(held)
        for segment, (a, b) in enumerate(zip(np.array_split(once, SEGMENTS), np.array_split(twice, SEGMENTS))):
            yield pa.RecordBatch.from_pydict({"segment": [segment], "once": [zlib.compress(a.tobytes(), 1)], "twice": [zlib.compress(b.tobytes(), 1)]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        once = twice = None
        for a, b in zip(frame["once"], frame["twice"]):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
            once, twice = (a.copy(), b.copy()) if once is None else (once | a, twice | b | (once & a))
        return pd.DataFrame({"segment": frame["segment"].iloc[:1].to_numpy(), "twice": [zlib.compress(twice.tobytes(), 1)]})

    # As many partial filters as the cluster has task slots (times four), however large the input.
    slots = 4 * docs.sparkSession.sparkContext.defaultParallelism
    partial = docs.select(column).coalesce(min(partitions_of(docs), slots)).mapInArrow(freed(fill), "segment long, once binary, twice binary")
    return partial.groupBy("segment").applyInPandas(merge, "segment long, twice binary")


def repeated_lines(docs: DataFrame, column: str = "text", min_docs: int = 10, min_chars: int = 1, first: str | None = None) -> DataFrame:
    """(key binary, n_docs long, owner): keys of lines found in at least ``min_docs`` documents, counted exactly.

    ``owner`` is the smallest value of the integer column ``first`` among those documents (null without ``first``).
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_KEY * (1 + size // 40) - 1).bit_length()))
    parts = sorted(_filters(docs, column, bits, min_chars).collect())
    bitmap = spark.sparkContext.broadcast(b"".join(zlib.decompress(row["twice"]) for row in parts))

    def suspects(batches):
        twice, seen = np.frombuffer(bitmap.value, np.uint8), {}

        def flush():
            out = pa.RecordBatch.from_pydict({
                "key": pa.array(list(seen), pa.binary()), "n": pa.array([n for n, _ in seen.values()], pa.int64()),
                "owner": pa.array([o for _, o in seen.values()], pa.int64()),
            })
            seen.clear()
            return out

        for batch in batches:
            owners = batch.column(first).to_pylist() if first else [None] * batch.num_rows
            keys, who = [], []
            for text, owner in zip(_texts(batch, column), owners):
                own = _document_keys(text, min_chars)
                keys.extend(own)
                who.extend([owner] * len(own))
                if len(keys) > 50_000:
                    _count(keys, who, twice, bits, seen)
                    keys, who = [], []
            _count(keys, who, twice, bits, seen)
            if len(seen) > 200_000:
                yield flush()
        yield flush()

    counted = docs.select(column, *([first] if first else [])).mapInArrow(freed(suspects), "key binary, n long, owner long")
    return counted.groupBy("key").agg(F.sum("n").alias("n_docs"), F.min("owner").alias("owner")).where(F.col("n_docs") >= min_docs)


def _count(keys: list[bytes], who: list, twice: np.ndarray, bits: int, seen: dict) -> None:
    if not keys:
        return
    for key, owner, hit in zip(keys, who, _has(twice, _places(keys, bits)).tolist()):
        if hit:
            n, least = seen.get(key, (0, None))
            seen[key] = (n + 1, owner if least is None or (owner is not None and owner < least) else least)


def dedup_lines(docs: DataFrame, column: str = "text", min_docs: int = 10, min_chars: int = 1, first: str | None = None) -> DataFrame:
    """The documents with repeated lines taken out of ``column``, plus ``n_lines``, ``n_dropped`` and ``kept_sha256``.

    The 128-bit digests of repeated keys are broadcast in blocks of at most ``BROADCAST_BYTES``; each block is one narrow
    pass over the documents. ``first`` names an integer id: the document with its smallest value keeps the line once.
    """
    names = [n for n in docs.columns if n not in ("n_lines", "n_dropped", "kept_sha256")]
    docs = docs.select(*names)
    repeated = written(repeated_lines(docs, column, min_docs, min_chars, first), "repeated-lines")
    blocks = max(1, -(-repeated.count() * 64 // BROADCAST_BYTES))
    out = docs
    for number in range(blocks):
        part = repeated if blocks == 1 else repeated.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == number)
        block = docs.sparkSession.sparkContext.broadcast(dict(_digests(part)))
        out = out.mapInArrow(freed(_dropper(block, column, number == 0, first)), _schema(docs))
    return out


def _digests(part: DataFrame):
    def narrow(batches):
        for batch in batches:
            marks = [xxhash.xxh3_128_digest(k.as_py()) for k in batch.column("key")]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), batch.column("owner")], names=["d", "owner"])

    for row in part.select("key", "owner").mapInArrow(narrow, "d binary, owner long").toLocalIterator():
        yield bytes(row["d"]), row["owner"]


def _schema(docs: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])


def _dropper(block, column: str, start: bool, first: str | None):
    def drop(batches):
        bad = block.value
        for batch in batches:
            owners = batch.column(first).to_pylist() if first else None
            texts, counts, dropped, digests = [], [], [], []
            for i, text in enumerate(_texts(batch, column)):
                lines = text.split(b"\n")
                marks = [xxhash.xxh3_128_digest(k) for k in keys_of(text.translate(LOWER_TABLE).split(b"\n"))]
                if owners is None:
                    kept = [line for line, d in zip(lines, marks) if d not in bad]
                else:
                    kept, shown = [], set()
                    for line, d in zip(lines, marks):
                        if d not in bad or (owners[i] is not None and bad[d] == owners[i] and d not in shown):
                            kept.append(line)
                        shown.add(d)
                whole = b"\n".join(kept)
                texts.append(whole)
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
                digests.append(hashlib.sha256(whole).hexdigest())
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns[column] = pa.array(texts, pa.binary()).cast(pa.string()) if sum(map(len, texts)) < 2**31 else pa.array(texts, pa.large_binary()).cast(pa.large_string())
            if start:
                columns["n_lines"], columns["n_dropped"] = pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())
            else:
                columns["n_dropped"] = pa.array([a + b for a, b in zip(columns["n_dropped"].to_pylist(), dropped)], pa.int64())
            columns["kept_sha256"] = pa.array(digests, pa.string())
            order = [n for n in batch.schema.names if n not in ("n_lines", "n_dropped", "kept_sha256")]
            yield pa.RecordBatch.from_pydict({n: columns[n] for n in [*order, "n_lines", "n_dropped", "kept_sha256"]})

    return drop
