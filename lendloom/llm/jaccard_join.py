"""Exact Jaccard join of word-shingle sets by universe partition.

Two sets of sizes a <= b with Jaccard at least t differ in at most H(a, b) shingles. A hash parts the universe of shingles into
segments; if two sets are compared on more than H segments, one of these must be equal (pigeonhole). The number of segments
depends on the size band of the smaller set, so a document is indexed in its own band and, as the larger partner, in the band
below if its size reaches it.

A band is allocated in one of two ways, whichever costs less (signatures plus expected candidates, from the band's number of
sets and their mean similarity, both measured over all documents):

* exact: H + 1 segments and a few more, signed whole. The extra segments pay for not signing empty ones;
* one deletion: (H + 1) / 2 segments, signed whole and with each shingle left out, since then one of them differs in at most
  one shingle.

Equal sets are first reduced to one representative. Signatures are counted per task before they are shuffled, in blocks. What
shares a signature is a bucket; a bucket is never expanded to pairs at once:

1. every document is compared with the smallest member of most of its buckets; the links found give components;
2. only members of different components are still compared, in blocks, behind a bound: the summed difference of two small
   histograms of shingles never exceeds the true difference. A pair that shares many buckets is passed on by the task of the
   first of them alone.

Every candidate is verified on the whole sets. Both steps lose nothing: a linked pair shares a bucket, and is either compared or
already in one component.

Words are separated by ASCII white space, A-Z lower-cased. Fewer words than ``size`` are one shingle; a text without words has
the empty set and no links. Repeated rows with the same id are one document if their texts agree; otherwise each is linked
with what it is like, under the one id. Null ids are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import batches_of, components, freed, gathered, mix, of_planes, partitions_of, planes, shingle_hashes, shuffles_dropped, slices, word_hashes, written

SIZE, PERCENT = 5, 80
RATIO = 1.6
SLICE_BYTES = 1 << 19
HISTOGRAM = 512
BROADCAST_IDS = 4_000_000
HELD_SIGNATURES = 600_000
BUCKET_BLOCK = 1500
BATCH_ROWS = 1000
FIRST_SIGNATURES = 64
_SEGMENT, _TOKEN, _HIST = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def most_difference(a: int, b: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of sets of sizes a and b that link; -1 if none can."""
    common = -(-percent * (a + b) // (100 + percent))
    return a + b - 2 * common if common <= min(a, b) else -1


def band_starts(largest: int) -> list[int]:
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, int(starts[-1] * RATIO)))
    return starts


class Plan:
    """How many segments a set of a size is signed on, per band, and how."""

    def __init__(self, largest: int, percent: int, statistics: dict[int, tuple[int, float]]):
        self.percent, self.starts = percent, band_starts(largest)
        self.parts: list[tuple[int, int, bool]] = []
        for band in range(len(self.starts) - 1):
            top = self.starts[band + 1] - 1
            need = self.need(band, top)
            spare = 1 + math.ceil(0.1 * (need + 1))
            sets, alike = statistics.get(band, (0, 0.0))
            size = max(1, (self.starts[band] + top) // 2)
            exact, halves = need + 1 + spare, (need + 2) // 2

            def cost(signatures: int, tokens: float, sets=sets, alike=alike) -> float:
                return signatures * (1 + sets * min(1.0, alike) ** max(1.0, tokens))

            if cost(exact, size / exact) <= cost(halves + size, size / halves - 1):
                self.parts.append((exact, spare, False))
            else:
                self.parts.append((halves, 0, True))

    def need(self, band: int, size: int) -> int:
        """The largest difference that a set of this size can have to a partner it meets in the band."""
        top = self.starts[band + 1] - 1
        # The difference grows with the sum of the sizes but for its parity: the last few sums hold the largest.
        if size <= top:
            pairs = [(size, b) for b in range(size, size * 100 // self.percent + 1)][-12:]
        else:
            pairs = [(a, size) for a in range(max(1, top - 3), top + 1)]
        return max(0, *(most_difference(a, b, self.percent) for a, b in pairs))

    def bands(self, size: int) -> list[int]:
        own = int(np.searchsorted(self.starts, size, "right")) - 1
        low = own
        while low > 0 and -(-size * self.percent // 100) <= self.starts[low] - 1:
            low -= 1
        return list(range(low, own + 1))

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        """All signatures of a set."""
        out = []
        tokens = mix(shingles ^ _TOKEN)
        place = mix(shingles ^ _SEGMENT) >> np.uint64(32)
        for band in self.bands(len(shingles)):
            segments, spare, delete = self.parts[band]
            used = segments if delete else min(segments, self.need(band, len(shingles)) + 1 + spare)
            at = ((place * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)
            inside = at < used
            at, own = at[inside], tokens[inside]
            sums = np.zeros(used, np.uint64)
            np.add.at(sums, at, own)
            counts = np.bincount(at, minlength=used)
            names = mix(np.uint64(band << 32) + np.arange(used, dtype=np.uint64))
            signed = mix(sums ^ names)
            if delete:
                out += [signed, mix((sums[at] - own) ^ names[at])]
            elif (counts == 0).sum() <= spare:
                out.append(signed[counts > 0])
            else:
                out.append(signed)
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _sets(batches, id_column: str, column: str, size: int):
    for batch in batches:
        ids = batch.column(id_column)
        for low, high, data, bounds in slices(batch.column(column), SLICE_BYTES):
            words, begins = word_hashes(data, bounds)
            yield ids.slice(low, high - low), shingle_hashes(words, begins, size)


def set_names(docs: DataFrame, id_column: str = "doc_id", column: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, least): the size, a 128-bit name and the smallest hash of every document's set."""

    def name(batches):
        for ids, sets in _sets(batches, id_column, column, size):
            h1 = [int(mix(s ^ _TOKEN).sum(dtype=np.uint64)) for s in sets]
            h2 = [int(mix(s ^ _HIST).sum(dtype=np.uint64)) for s in sets]
            least = [int(s[0]) if len(s) else 0 for s in sets]
            as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(list(map(len, sets)), pa.int64()), as_long(h1), as_long(h2), as_long(least)], names=["doc_id", "n_shingles", "h1", "h2", "least"])

    return docs.where(F.col(id_column).isNotNull()).select(id_column, column).mapInArrow(freed(name), "doc_id long, n_shingles long, h1 long, h2 long, least long")


def only(docs: DataFrame, ids: DataFrame, id_column: str, how: str) -> DataFrame:
    """Documents with (or without) an id. The ids are broadcast if they are counted to be few, else joined by a shuffle."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = ids.select(F.col(ids.columns[0]).alias("_only"))
    return docs.join(F.broadcast(ids) if few else ids, F.col(id_column) == F.col("_only"), how)


def shared_signatures(docs: DataFrame, plan: Plan, id_column: str, column: str, size: int) -> DataFrame:
    """(sig, doc): the signatures that at least two documents have.

    A task emits one entry for each of its signatures, as blocks per part of the hash range, and apart from that the full
    membership of those that several of its own documents have; so the owner of a hot signature's part gets an entry per task.
    """
    parts = 4 * partitions_of(docs)
    held = docs.sparkSession.sparkContext.broadcast(plan)

    def emit(batches):
        sigs, owners, held_rows, turn = [], [], 0, 0

        def flush():
            nonlocal turn
            sig, doc = np.concatenate(sigs), np.concatenate(owners)
            order = np.lexsort((doc, sig))
            sig, doc = sig[order], doc[order]
            first = np.concatenate([[True], sig[1:] != sig[:-1]])
            several = ~first | np.concatenate([~first[1:], [False]])
            part = ((sig >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            one, where = sig[first], np.searchsorted(part[first], np.arange(parts + 1))
            docs_of = doc[first]
            groups, blobs, doc_blobs = [], [], []
            for p in range(parts):
                a, b = where[p], where[p + 1]
                if b > a:
                    groups.append(p)
                    blobs.append(planes(one[a:b]))
                    doc_blobs.append(planes(docs_of[a:b]))
            if several.any():
                groups.append(parts + int(sig[0] % np.uint64(1 << 20)) + turn)
                blobs.append(planes(sig[several]))
                doc_blobs.append(planes(doc[several]))
            turn += 1
            return pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(blobs, pa.binary()), pa.array(doc_blobs, pa.binary())], names=["part", "sigs", "docs"])

        for ids, sets in _sets(batches, id_column, column, size):
            for doc, shingles in zip(ids.to_pylist(), sets):
                if len(shingles):
                    signed = held.value.sign(shingles)
                    sigs.append(signed)
                    owners.append(np.full(len(signed), doc, np.int64))
                    held_rows += len(signed)
            if held_rows > HELD_SIGNATURES:
                yield flush()
                sigs, owners, held_rows = [], [], 0
        if sigs:
            yield flush()

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sig, doc = of_planes(frame["sigs"], np.uint64), of_planes(frame["docs"], np.int64)
        if key[0] < parts:
            order = np.argsort(sig, kind="stable")
            sig, doc = sig[order], doc[order]
            same = sig[1:] == sig[:-1]
            several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            sig, doc = sig[several], doc[several]
        return pd.DataFrame({"sig": sig.view(np.int64), "doc": doc})

    blocks = docs.select(id_column, column).mapInArrow(freed(emit), "part long, sigs binary, docs binary")
    return blocks.groupBy("part").applyInPandas(meet, "sig long, doc long")


def _kept_sets(docs: DataFrame, id_column: str, column: str, size: int) -> DataFrame:
    """(doc, n, hist, shingles): whole sets, for the documents that have candidates."""

    def keep(batches):
        for ids, sets in _sets(batches, id_column, column, size):
            hist = [np.minimum(np.bincount((mix(s ^ _HIST) >> np.uint64(55)).astype(np.int64), minlength=HISTOGRAM), 255).astype(np.uint8).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array(hist, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc", "n", "hist", "shingles"])

    return docs.select(id_column, column).mapInArrow(freed(keep), "doc long, n long, hist binary, shingles binary")


def _may_link(na, nb, difference, percent):
    """False where sizes or the least difference rule a link out."""
    common = -(-percent * (na + nb) // (100 + percent))
    return (common <= np.minimum(na, nb)) & (difference <= na + nb - 2 * common)


def _histograms(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, HISTOGRAM).astype(np.int16)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, after the histogram bound, by exact intersection."""

    def bound(frames):
        for frame in frames:
            if len(frame):
                far = np.abs(_histograms(frame["ha"]) - _histograms(frame["hb"])).sum(axis=1, dtype=np.int64)
                yield frame.loc[_may_link(frame["na"].to_numpy(), frame["nb"].to_numpy(), far, percent), ["a", "b"]]

    def exact(frames):
        for frame in frames:
            good = []
            for x, y in zip(frame["sa"], frame["sb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield frame.loc[good, ["a", "b"]]

    small = sets.select("doc", "n", "hist")
    sized = pairs.join(small.toDF("a", "na", "ha"), "a").join(small.toDF("b", "nb", "hb"), "b")
    left = written(sized.mapInPandas(freed(bound), "a long, b long"), "pairs")
    # Whole sets travel only for documents that still have a pair.
    whole = only(sets.select("doc", "shingles"), left.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "doc", "left_semi")
    return left.join(whole.toDF("a", "sa"), "a").join(whole.toDF("b", "sb"), "b").select("a", "b", "sa", "sb").mapInPandas(freed(exact), "a long, b long")


def _stars(shared: DataFrame) -> DataFrame:
    """At most one pair per document: with the smallest member of most of its buckets."""
    least = shared.groupBy("sig").agg(F.min("doc").alias("a"))
    met = shared.join(least, "sig").where("a < doc").groupBy("a", "doc").count()
    best = met.groupBy("doc").agg(F.max_by("a", F.struct("count", -F.col("a"))).alias("a"))
    return best.select("a", F.col("doc").alias("b"))


def _mixed(shared: DataFrame, links: DataFrame) -> DataFrame:
    """(sig, doc, comp, members): the buckets whose members are in different components of the links."""
    labels = written(components(links), "labels")
    named = shared.join(labels, shared["doc"] == labels["node"], "left").select("sig", "doc", F.coalesce("component", "doc").alias("comp"))
    mixed = named.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("members")).where("x < y")
    return named.join(mixed.select("sig", "members"), "sig")


def _rest(mixed: DataFrame, parts: int, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket but different components that pass the histogram bound."""
    firsts = mixed.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list("sig")), 1, FIRST_SIGNATURES).alias("firsts"))
    rows = mixed.join(firsts, "doc").join(sets.select("doc", "n", "hist"), "doc")
    blocks = F.ceil(F.col("members") / BUCKET_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "comp", "n", "hist", "firsts")

    def compare(batches):
        if (table := gathered(batches)) is None:
            return
        sig, i, j, own, doc, comp, n = (table.column(c).to_numpy() for c in ("sig", "i", "j", "own", "doc", "comp", "n"))
        order = np.lexsort((doc, own, j, i, sig))
        group = np.cumsum(np.concatenate([[True], (np.diff(sig[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)]))
        _, first, code = np.unique(doc, return_index=True, return_inverse=True)
        hist = _histograms(table.column("hist").take(pa.array(first)).to_pylist())
        firsts, here = table.column("firsts").take(pa.array(first)).to_pylist(), set(np.unique(sig).tolist())
        doc, comp, n, code, own, across = doc[first], comp[first], n[first], code[order], own[order], (i != j)[order]
        sizes = np.bincount(group)[group]
        left = sizes - 1 - (np.arange(len(group)) - np.searchsorted(group, group))
        longest = np.argsort(-left, kind="stable")
        ranked = -left[longest]
        seen, found, held = np.zeros(0, np.int64), [np.zeros(0, np.int64)], []

        def flush() -> None:
            nonlocal seen, held
            pair = np.unique(np.concatenate(held))
            if len(seen):
                pair = pair[seen[np.minimum(np.searchsorted(seen, pair), len(seen) - 1)] != pair]
            for part in np.array_split(pair, max(1, len(pair) // 10_000)):
                x, y = part // len(doc), part % len(doc)
                found.append(part[_may_link(n[x], n[y], np.abs(hist[x] - hist[y]).sum(axis=1, dtype=np.int64), percent)])
            if len(seen) < 5_000_000:  # beyond this a pair may be looked at again, which changes nothing
                seen = np.union1d(seen, pair)
            held = []

        # Members of a group stand together: compare each with the one ``step`` places on, while its group reaches that far.
        for step in range(1, int(sizes.max())):
            at = longest[:np.searchsorted(ranked, -step, "right")]
            at = at[~across[at] | (own[at] != own[at + step])]
            x, y = code[at], code[at + step]
            ok = (comp[x] != comp[y]) & _may_link(n[x], n[y], 0, percent)
            held.append(np.minimum(x[ok], y[ok]) * len(doc) + np.maximum(x[ok], y[ok]))
            if sum(map(len, held)) > 1_000_000 or len(held) > 500:
                flush()
        if held:
            flush()
        pair = np.unique(np.concatenate(found))

        def first_here(x: int, y: int) -> bool:
            """Whether the smallest bucket known to be common is one of this task's; every task that meets the pair finds the same."""
            return (least := min(set(firsts[x]).intersection(firsts[y]), default=None)) is None or least in here

        pair = pair[np.array([first_here(x, y) for x, y in zip((pair // len(doc)).tolist(), (pair % len(doc)).tolist())], bool)]
        yield pa.RecordBatch.from_arrays([pa.array(doc[pair // len(doc)]), pa.array(doc[pair % len(doc)])], names=["a", "b"])

    return rows.repartition(parts, "sig", "i", "j").mapInArrow(freed(compare), "a long, b long").distinct()


def jaccard_components(docs: DataFrame, *, id_column: str = "doc_id", column: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document with an id."""
    with batches_of(docs.sparkSession, BATCH_ROWS), shuffles_dropped(docs.sparkSession):
        return _joined(docs, id_column, column, size, percent)


def _joined(docs: DataFrame, id_column: str, column: str, size: int, percent: int) -> DataFrame:
    docs = docs.where(F.col(id_column).isNotNull()).select(id_column, column)
    names = written(set_names(docs, id_column, column, size), "sets")
    classes = names.where("n_shingles > 0").groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # Of groups of equal sets: every document but the representative leaves the join.
    several = classes.where("copies > 1").drop("copies")
    copies = written(names.join(several, ["n_shingles", "h1", "h2"]).where("doc_id <> rep").select("doc_id", "rep").distinct(), "copies")
    largest = names.agg(F.max("n_shingles")).first()[0] or 1
    plan = Plan(largest, percent, _statistics(names, classes, largest))
    single = names.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    absent = copies.select("doc_id").join(single, "doc_id", "left_anti")
    reps = only(docs, absent, id_column, "left_anti")
    shared = written(shared_signatures(reps, plan, id_column, column, size).distinct(), "signatures")
    sets = written(_kept_sets(only(reps, shared.select("doc").distinct(), id_column, "left_semi"), id_column, column, size), "candidates")
    first = written(_verified(_stars(shared), sets, percent), "links")
    mixed = _mixed(shared, first)
    # Every row of the rest carries a histogram, so a task gets an eighth of the signatures of a scan's partition.
    parts = 8 * max(partitions_of(shared), shared.sparkSession.sparkContext.defaultParallelism)
    # Written, since the components begin with a Python step: two in one task would keep twice as many workers on an executor.
    second = written(_verified(_rest(mixed, parts, sets, percent), sets, percent), "links")
    links = first.unionByName(second).unionByName(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    final = components(links)
    out = names.select("doc_id", "n_shingles").join(final, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _statistics(names: DataFrame, classes: DataFrame, largest: int) -> dict[int, tuple[int, float]]:
    """Per band: the number of different sets, and the chance that two of them have the same smallest hash (mean similarity)."""
    starts = band_starts(largest)
    bounds = F.array(*map(F.lit, starts))
    sets = names.where("n_shingles > 0").dropDuplicates(["n_shingles", "h1", "h2"])
    sets = sets.withColumn("band", F.size(F.filter(bounds, lambda s: s <= F.col("n_shingles"))) - 1)
    rows = sets.groupBy("band", "least").count().groupBy("band").agg(F.sum("count").alias("n"), F.sum(F.expr("count * (count - 1)")).alias("same")).collect()
    return {r["band"]: (r["n"], r["same"] / max(1, r["n"] * (r["n"] - 1))) for r in rows}
