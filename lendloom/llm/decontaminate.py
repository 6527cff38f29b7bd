"""Find passages of a benchmark in documents with a positional inverted index.

The index is sharded by document: a shard holds, for each term of the benchmark, the sorted list of its places in the
shard's documents. A phrase is found by taking the list of its rarest term in the shard, moving it back by the term's offset,
and keeping the places that the lists of the other terms, from rare to frequent, hold at their own offsets. Shards answer
alone, so no posting is shuffled and a frequent term or passage stays spread over all shards.

The benchmark is read in blocks of bounded size; each block is one pass over the documents.

Words are maximal runs of letters, digits and non-ASCII characters, lower-cased (A-Z). A phrase is ``size`` consecutive words
of an item; an item with fewer words is one phrase, one without words has none. Items without id are left out; rows with the
same item id are one item.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.llm.common import ALNUM, slices, word_hashes

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20


class Phrases:
    """The distinct phrases of a block of items: a matrix of term numbers (short ones padded with -1) and their items."""

    def __init__(self, texts: list[str], items: list[str], size: int):
        found: dict[bytes, set[int]] = {}
        self.items = items
        for number, text in enumerate(texts):
            words, _ = word_hashes(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]), ALNUM)
            for at in range(max(1, len(words) - size + 1) if len(words) else 0):
                found.setdefault(words[at:at + size].tobytes(), set()).add(number)
        phrases = [np.frombuffer(k, np.uint64) for k in found]
        self.terms = np.unique(np.concatenate(phrases)) if phrases else np.zeros(0, np.uint64)
        self.lengths = np.array([len(p) for p in phrases], np.int64)
        self.matrix = np.full((len(phrases), size), -1, np.int64)
        for row, phrase in enumerate(phrases):
            self.matrix[row, :len(phrase)] = np.searchsorted(self.terms, phrase)
        self.owners = [sorted(v) for v in found.values()]


class Postings:
    """One shard of the index: term number and place of every word that is a benchmark term, sorted by both."""

    def __init__(self, words: np.ndarray, begins: np.ndarray, terms: np.ndarray):
        at = np.minimum(np.searchsorted(terms, words), max(0, len(terms) - 1))
        known = np.flatnonzero(terms[at] == words) if len(terms) else np.zeros(0, np.int64)
        # A gap between documents keeps a phrase from crossing them.
        self.begins, self.gap = begins, 64
        document = np.searchsorted(begins, known, "right") - 1
        self.stride = int(begins[-1]) + self.gap * len(begins) + 1
        self.keys = np.sort(at[known] * self.stride + known + document * self.gap)
        self.bounds = np.searchsorted(self.keys, np.arange(len(terms) + 1) * self.stride)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = term * self.stride + place
        at = np.searchsorted(self.keys, key)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key) & (place >= 0)

    def phrases(self, matrix: np.ndarray, lengths: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """(phrase row, place) of all occurrences, by offset-adjusted intersection from the rarest term."""
        if not len(self.keys) or not len(matrix):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        counts = np.diff(self.bounds)
        sizes = np.where(matrix >= 0, counts[np.maximum(matrix, 0)], np.iinfo(np.int64).max)
        order = np.argsort(sizes, axis=1, kind="stable")
        rarest = sizes[np.arange(len(matrix)), order[:, 0]]
        live = np.flatnonzero(rarest > 0)
        rows_out, places_out = [], []
        low = 0
        totals = np.cumsum(rarest[live])
        while low < len(live):
            high = max(low + 1, int(np.searchsorted(totals, (totals[low - 1] if low else 0) + most, "right")))
            part = live[low:high]
            n = rarest[part]
            row = np.repeat(part, n)
            first = order[part, 0]
            begin = self.bounds[matrix[part, first]]
            inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            place = self.keys[np.repeat(begin, n) + inside] % self.stride - np.repeat(first, n)
            for k in range(1, matrix.shape[1]):
                offset = order[row, k]
                term = matrix[row, offset]
                ok = (term < 0) | self.has(np.maximum(term, 0), place + offset)
                row, place = row[ok], place[ok]
                if not len(row):
                    break
            rows_out.append(row)
            places_out.append(place)
            low = high
        return (np.concatenate(rows_out), np.concatenate(places_out)) if rows_out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def near(self, terms: list[int], slop: int) -> np.ndarray:
        """Places of the rarest term that have every other term at most ``slop`` words away, in the same document."""
        spans = sorted(({t: self.keys[self.bounds[t]:self.bounds[t + 1]] - t * self.stride for t in terms}).values(), key=len)
        kept = spans[0] if spans else np.zeros(0, np.int64)
        for other in spans[1:]:
            low, high = np.searchsorted(other, kept - slop), np.searchsorted(other, kept + slop, "right")
            kept = kept[high > low]
        return kept

    def document(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of the shard and word number inside the document, for places."""
        starts = self.begins[:-1] + np.arange(len(self.begins) - 1) * self.gap
        row = np.searchsorted(starts, places, "right") - 1
        return row, places - starts[row]


def _blocks(benchmark: DataFrame, key: str, column: str, most: int):
    texts, items, size = [], [], 0
    for row in benchmark.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(column).alias("t")).toLocalIterator():
        texts.append(row["t"])
        items.append(row["k"])
        size += len(row["t"] or "")
        if size > most:
            yield texts, items
            texts, items, size = [], [], 0
    if items:
        yield texts, items


HITS = "n_words long, hit_starts array<long>, hit_ends array<long>, items array<string>"


def phrase_hits(docs: DataFrame, benchmark: DataFrame, *, key: str = "item_id", column: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with ``n_words``, the word ranges [start, end) inside found phrases, and the ids of the items found.

    A clashing input column is replaced. Null texts have no words.
    """
    names = [n for n in docs.columns if n not in ("n_words", "hit_starts", "hit_ends", "items")]
    out = docs.select(*names)
    schema = T.StructType([*out.schema.fields, *T._parse_datatype_string(HITS).fields])
    blocks = _blocks(benchmark, key, column, block_bytes)
    for number, (texts, items) in enumerate(blocks):
        phrases = out.sparkSession.sparkContext.broadcast(Phrases(texts, items, size))
        out = out.mapInArrow(_matcher(phrases, column, number > 0), schema)
    if len(out.columns) == len(names):  # no items at all
        out = out.mapInArrow(_matcher(out.sparkSession.sparkContext.broadcast(Phrases([], [], size)), column, False), schema)
    return out


def _cover(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Union of ranges as disjoint sorted ranges."""
    if not len(starts):
        return [], []
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return starts[new].tolist(), ends[np.concatenate([new[1:] - 1, [len(ends) - 1]])].tolist()


def _matcher(phrases, column: str, again: bool):
    def match(batches):
        wanted: Phrases = phrases.value
        for batch in batches:
            n_words, lows, highs, found = [], [], [], []
            for low, high, data, bounds in slices(batch.column(column), SHARD_BYTES):
                words, begins = word_hashes(data, bounds, ALNUM)
                shard = Postings(words, begins, wanted.terms)
                phrase, place = shard.phrases(wanted.matrix, wanted.lengths)
                row, at = shard.document(place)
                order = np.argsort(row, kind="stable")
                row, at, phrase = row[order], at[order], phrase[order]
                cut = np.searchsorted(row, np.arange(high - low + 1))
                n_words.extend(np.diff(begins).tolist())
                for i in range(high - low):
                    a, b = cut[i], cut[i + 1]
                    if a == b:
                        lows.append([]), highs.append([]), found.append([])
                        continue
                    one, two = _cover(at[a:b], at[a:b] + wanted.lengths[phrase[a:b]])
                    lows.append(one), highs.append(two)
                    found.append(sorted({wanted.items[x] for p in np.unique(phrase[a:b]) for x in wanted.owners[p]}))
            old = [n for n in batch.schema.names if n not in ("n_words", "hit_starts", "hit_ends", "items")]
            if again:
                for i, (s, e, t) in enumerate(zip(batch.column("hit_starts").to_pylist(), batch.column("hit_ends").to_pylist(), batch.column("items").to_pylist())):
                    lows[i], highs[i] = _cover(np.array([*s, *lows[i]], np.int64), np.array([*e, *highs[i]], np.int64))
                    found[i] = sorted({*t, *found[i]})
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in old), pa.array(n_words, pa.int64()), pa.array(lows, pa.list_(pa.int64())), pa.array(highs, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))],
                names=[*old, "n_words", "hit_starts", "hit_ends", "items"])

    return match


def contamination(docs: DataFrame, benchmark: DataFrame, *, size: int = WINDOW, one_in: int = 20) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated (hit words are at least one in ``one_in``)."""
    hits = phrase_hits(docs, benchmark, size=size)
    n_hit = F.aggregate(F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    flagged = hits.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256)})
    return flagged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))


def near_matches(docs: DataFrame, terms: list[str], slop: int, *, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, word long): places of the rarest of the given words that have all the others within ``slop`` words."""
    hashed = np.concatenate([word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), ALNUM)[0] for t in terms]) if terms else np.zeros(0, np.uint64)
    wanted = np.unique(hashed)
    gap = Postings(np.zeros(0, np.uint64), np.zeros(1, np.int64), wanted).gap
    if slop >= gap:
        raise ValueError(f"slop must be below {gap}")

    def search(batches):
        for batch in batches:
            ids = batch.column(id_column)
            for low, high, data, bounds in slices(batch.column(column), SHARD_BYTES):
                shard = Postings(*word_hashes(data, bounds, ALNUM), wanted)
                row, at = shard.document(shard.near(list(range(len(wanted))), slop))
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low).take(pa.array(row, pa.int64())), pa.array(at, pa.int64())], names=["id", "word"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, column).mapInArrow(search, f"id {kind}, word long")


