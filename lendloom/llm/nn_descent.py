"""Near-duplicate vectors by NN-descent.

The neighbour graph starts from random hyperplanes: vectors on the same side of a few of them meet in groups of at most
``MEETING`` and take their best partners there. It is then refined: around every vector its neighbours and the vectors that
count it among theirs are compared with one another, and each keeps the best it has met. A list whose members are all near
duplicates is saturated and gets twice the places. Rounds end when they find next to no new edges near the threshold.

Edges over the threshold, checked in double precision, give components. Recall is audited: a bounded sample of vectors is
compared with all vectors, block by block; links it finds across components join them, and while too many of its vectors, by size of
component, miss a link, the graph is met again on new hyperplanes; if that stays so, an error is raised. Components of more than ``PLACES`` vectors,
whose lists may hold nothing but their own, are compared with one another exactly. Then the links inside components are counted exactly, so lists that are still saturated lose
nothing: small components are compared whole; in a large one, vectors near its mean direction are linked with each other by
the triangle inequality on angles, and only the others are compared, in blocks.

Vectors that are null, empty, zero, or hold a null or a number that is not finite link with nothing; nor do vectors of
different lengths. Equal vectors are first reduced to one. Null ids are left out; rows that repeat an id and its vector are one.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.llm.common import components, gathered, partitions_of, written

THRESHOLD = 0.9
PLACES, MOST_PLACES = 8, 32
TABLES, MEETING = 6, 64
ROUNDS, ENOUGH = 6, 0.002
AUDIT_ROWS, AUDIT_RECALL, AUDITS = 500, 0.995, 4
SMALL = 512
_VECTORS = "id long, v binary, copies long"


def _matrix(blobs, kind=np.float64) -> np.ndarray:
    """Vectors of several lengths side by side, short ones padded with zeros."""
    rows = [np.frombuffer(b, kind) for b in blobs]
    wide = max(map(len, rows), default=0)
    if all(len(r) == wide for r in rows):
        return np.array(rows, np.float64).reshape(len(rows), wide)
    out = np.zeros((len(rows), wide))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def unit_vectors(rows: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, v, digest): unit vectors as bytes; null where a vector links with nothing."""

    def unit(batches):
        for batch in batches:
            ids, out, names = [], [], []
            for key, raw in zip(batch.column(id_column).cast(pa.int64()).to_pylist(), batch.column(column).to_pylist()):
                v = np.array([np.nan if x is None else x for x in raw] if raw else [], np.float64)
                peak = np.abs(v).max() if len(v) else 0.0
                good = len(v) > 0 and np.isfinite(v).all() and peak > 0
                ids.append(key)
                out.append((v / peak / np.linalg.norm(v / peak)).tobytes() if good else None)
                names.append(hashlib.md5(v.tobytes()).hexdigest() if good else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(names, pa.string())], names=["id", "v", "digest"])

    return rows.where(F.col(id_column).isNotNull()).select(id_column, column).mapInArrow(unit, "id long, v binary, digest string")


def _best(owner: np.ndarray, other: np.ndarray, near: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Indices of the best ``places`` different partners of every owner."""
    order = np.lexsort((other, -near, owner))
    first = np.unique(np.stack([owner[order], other[order]]), axis=1, return_index=True)[1]
    order = order[np.sort(first)]
    begin = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))
    return order[rank < places[order]]


def _edges(owner, other, near) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(owner.astype(np.int64)), pa.array(other.astype(np.int64)), pa.array(near.astype(np.float32))], names=["id", "other", "near"])


EDGES = "id long, other long, near float"


def _meet(vectors: DataFrame, parts: int, rows: int, seed: int) -> DataFrame:
    """Proposed edges from ``TABLES`` sets of random hyperplanes."""
    bits = max(0, int(math.log2(max(1, rows / (MEETING / 2)))))

    def place(batches):
        for batch in batches:
            v = _matrix(batch.column("v").to_pylist())
            for table in range(TABLES):
                # Row d of the planes depends on the seed and d alone, so vectors of any length get the same planes.
                planes = np.array([np.random.default_rng((seed, table, d)).standard_normal(bits) for d in range(v.shape[1])]).reshape(v.shape[1], bits)
                code = ((v @ planes) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code * TABLES + table), batch.column("id"), batch.column("v")], names=["code", "id", "v"])

    placed = vectors.select("id", "v").mapInArrow(place, "code long, id long, v binary")
    sizes = placed.groupBy("code").count()
    salted = placed.join(sizes, "code").withColumn("salt", F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(F.col("count") / MEETING)))

    def compare(batches):
        if (table := gathered(batches)) is None:
            return
        frame = table.to_pandas().sort_values(["code", "salt", "id"])
        key = frame[["code", "salt"]].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        ids = frame["id"].to_numpy()
        found = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high - low > 1:
                v = _matrix(frame["v"].iloc[low:high])
                near = v @ v.T
                np.fill_diagonal(near, -2)
                k = min(PLACES, high - low - 1)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                own = np.repeat(np.arange(high - low), k)
                found.append((ids[low:high][own], ids[low:high][top.ravel()], near[own, top.ravel()]))
        if found:
            yield _edges(*(np.concatenate(x) for x in zip(*found)))

    return salted.select("code", "salt", "id", "v").repartition(parts, "code", "salt").mapInArrow(compare, EDGES)


def _merge(edges: DataFrame, parts: int, threshold: float) -> DataFrame:
    """The best of every list: ``PLACES``, doubled while the list is filled with near duplicates, up to ``MOST_PLACES``."""

    def best(batches):
        if (table := gathered(batches)) is None:
            return
        owner, other, near = (table.column(c).to_numpy() for c in ("id", "other", "near"))
        distinct, code = np.unique(owner, return_inverse=True)
        keep = _best(owner, other, near, np.full(len(owner), MOST_PLACES))
        duplicates = np.bincount(code[keep], near[keep] >= threshold, minlength=len(distinct))
        places = np.where(duplicates < PLACES, PLACES, np.where(duplicates < 2 * PLACES, 2 * PLACES, MOST_PLACES))
        keep = _best(owner, other, near, places[code])
        for part in np.array_split(keep, max(1, len(keep) // 100_000)):
            yield _edges(owner[part], other[part], near[part])

    return edges.repartition(parts, "id").mapInArrow(best, EDGES)


def _around(graph: DataFrame, vectors: DataFrame, parts: int) -> DataFrame:
    """Proposed edges between the neighbours, and the vectors that have it as a neighbour, of every vector."""
    forward = graph.select(F.col("id").alias("center"), F.col("other").alias("member"), F.lit(False).alias("back"))
    back = graph.select(F.col("other").alias("center"), F.col("id").alias("member"), F.lit(True).alias("back"))
    small = vectors.select(F.col("id").alias("member"), F.col("v"))

    def sample(batches):
        # Of the many that may point at one vector, a task passes on a few, drawn by hash: forward lists carry all edges.
        if (table := gathered(batches)) is not None:
            center, member, back = (table.column(c).to_numpy() for c in ("center", "member", "back"))
            rank = np.where(back, (member * 2654435761 % 1000003) / 1000003.0, 2.0)
            keep = _best(center, member, rank, np.where(back, PLACES + MOST_PLACES, 2 * MOST_PLACES))
            yield pa.RecordBatch.from_arrays([pa.array(center[keep]), pa.array(member[keep])], names=["center", "member"])

    halves = back.repartition(parts, "member").mapInArrow(sample, "center long, member long").withColumn("back", F.lit(True))
    lists = forward.unionByName(halves).repartition(parts, "center").mapInArrow(sample, "center long, member long")
    itself = vectors.select(F.col("id").alias("center"), F.col("id").alias("member"))

    def shrink(batches):
        for batch in batches:
            v = [np.frombuffer(b, np.float64).astype(np.float16).tobytes() for b in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("member"), pa.array(v, pa.binary())], names=["member", "v"])

    filled = lists.unionByName(itself).join(small.mapInArrow(shrink, "member long, v binary"), "member")

    def compare(batches):
        if (table := gathered(batches)) is None:
            return
        center, member = table.column("center").to_numpy(), table.column("member").to_numpy()
        v = _matrix(table.column("v").to_pylist(), np.float16).astype(np.float32)
        order = np.argsort(center, kind="stable")
        member, v = member[order], v[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(center[order])) + 1, [len(order)]])
        found, held = [], 0
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            n = high - low
            if n > 1:
                near = v[low:high] @ v[low:high].T
                np.fill_diagonal(near, -2)
                k = min(PLACES, n - 1)
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                own = np.repeat(np.arange(n), k)
                found.append((member[low:high][own], member[low:high][top.ravel()], near[own, top.ravel()]))
                held += len(own)
            if held > 500_000:
                yield _shortened(found)
                found, held = [], 0
        if found:
            yield _shortened(found)

    def _shortened(found):
        owner, other, near = (np.concatenate(x) for x in zip(*found))
        keep = _best(owner, other, near, np.full(len(owner), MOST_PLACES))
        return _edges(owner[keep], other[keep], near[keep])

    return filled.select("center", "member", "v").repartition(parts, "center").mapInArrow(compare, EDGES)


def refine(graph: DataFrame, vectors: DataFrame, parts: int, threshold: float, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of neighbours-of-neighbours, until a round finds next to no new edges near or over the threshold.

    Edges of saturated lists do not count, neither as new nor as a share: they only swap one near duplicate for a nearer one.
    """
    close = F.col("near") >= threshold - 0.1
    for _ in range(rounds):
        wider = written(_merge(graph.unionByName(_around(graph, vectors, parts)), parts, threshold), "neighbours")
        filled = graph.where(close).groupBy("id").count().where(F.col("count") >= PLACES).select("id")
        open_ = written(wider.where(close).join(filled, "id", "left_anti"), "open")
        new = open_.join(graph, ["id", "other"], "left_anti").count()
        graph = wider
        if new <= ENOUGH * open_.count():
            break
    return graph


def threshold_links(graph: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """(a, b): edges of the graph that hold in double precision."""
    near = graph.where(F.col("near") >= threshold - 0.02).select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    pairs = near.join(vectors.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").join(vectors.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b")

    def exact(batches):
        for batch in batches:
            good = [len(x) == len(y) and float(np.dot(np.frombuffer(x), np.frombuffer(y))) >= threshold for x, y in zip(batch.column("va").to_pylist(), batch.column("vb").to_pylist())]
            ok = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    return pairs.mapInArrow(exact, "a long, b long")


def audit(vectors: DataFrame, labels: DataFrame, threshold: float, seed: int, rows: int = AUDIT_ROWS) -> DataFrame:
    """(a, b, stratum, missed): true links of a bounded random sample against all vectors; missed are those that cross components.

    The sample has as many vectors alone, in components of up to ``PLACES``, of up to ``SMALL``, and of more, as far as there are.
    """
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    known = vectors.join(labels, vectors["id"] == labels["node"], "left").join(sizes, "component", "left").select("id", "v", F.coalesce("size", F.lit(1)).alias("size"))
    strata = [F.col("size") == 1, F.col("size").between(2, PLACES), F.col("size").between(PLACES + 1, SMALL), F.col("size") > SMALL]
    picks = [known.where(s).orderBy(F.xxhash64("id", F.lit(seed))).select("id", "v", F.lit(k).alias("stratum")).limit(rows // len(strata)) for k, s in enumerate(strata)]
    chosen = [(r["id"], r["v"], r["stratum"]) for r in functools.reduce(DataFrame.unionByName, picks).collect()]
    shared = vectors.sparkSession.sparkContext.broadcast(chosen)

    def compare(batches):
        ids, strata = (np.array([c[k] for c in shared.value], np.int64) for k in (0, 2))
        size = [len(v) for _, v, _ in shared.value]
        for batch in batches:
            blobs = batch.column("v").to_pylist()
            both = _matrix([*(v for _, v, _ in shared.value), *blobs])
            near = both[len(ids):] @ both[:len(ids)].T
            own, at = np.nonzero(near >= threshold)
            other = batch.column("id").to_numpy()
            ok = (other[own] != ids[at]) & np.array([len(blobs[i]) == size[j] for i, j in zip(own, at)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[at][ok], other[own][ok], strata[at][ok])], names=["a", "b", "stratum"])

    true = vectors.select("id", "v").mapInArrow(compare, "a long, b long, stratum long")
    side = lambda n: labels.select(F.col("node").alias(n), F.col("component").alias(f"c{n}"))
    found = true.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return found.withColumn("missed", ~(F.coalesce("ca", "a") == F.coalesce("cb", "b")))


def short_strata(seen: DataFrame) -> list[tuple[int, int, int]]:
    """(stratum, vectors with links, of which some link is missed) where fewer than ``AUDIT_RECALL`` of the vectors have all links.

    A sampled vector that is alone and has a true link always misses it, so for those it is missed ones in the whole sample of vectors alone.
    """
    rows = seen.groupBy("stratum", "a").agg(F.max("missed").alias("missed")).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("missed").cast("long")).alias("short"))
    out = [(r["stratum"], AUDIT_ROWS // 4 if r["stratum"] == 0 else r["n"], r["short"]) for r in rows.collect()]
    return [x for x in out if x[2] > (1 - AUDIT_RECALL) * x[1]]


def _means(rows: DataFrame) -> DataFrame:
    """(component, width, m): the mean direction of every component."""

    def sums(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for (component, width), own in frame.groupby(["component", frame["v"].map(len)]):
                yield pa.RecordBatch.from_pydict({"component": [int(component)], "width": [int(width)], "v": [_matrix(own["v"]).sum(axis=0).tobytes()]})

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        total = _matrix(frame["v"]).sum(axis=0)
        size = np.linalg.norm(total)
        return pd.DataFrame({"component": frame["component"].iloc[:1].to_numpy(), "width": frame["width"].iloc[:1].to_numpy(), "m": [(total / size if size else total).tobytes()]})

    return rows.select("component", "v").mapInArrow(sums, "component long, width long, v binary").groupBy("component", "width").applyInPandas(mean, "component long, width long, m binary")


def _angles(rows: DataFrame) -> DataFrame:
    """The rows with the angle between v and m instead of m."""
    fields = [f for f in rows.schema.fields if f.name != "m"]

    def angle(batches):
        for batch in batches:
            v, m = _matrix(batch.column("v").to_pylist()), _matrix(batch.column("m").to_pylist())
            far = np.arccos(np.clip((v * m).sum(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(far)], names=[*(f.name for f in fields), "angle"])

    return rows.mapInArrow(angle, T.StructType([*fields, T.StructField("angle", T.DoubleType())]))


def links_across(vectors: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between components of more than ``PLACES`` vectors, at least one for each two that are linked.

    The lists of such vectors may hold their own component alone, so these components are compared exactly: by their mean
    directions and radii first, then the vectors that are near enough to the other mean, block by block.
    """
    reach = math.acos(threshold) + 1e-6
    rows = vectors.join(labels, vectors["id"] == labels["node"]).select("id", "v", "component", F.length("v").cast("long").alias("width"))
    sizes = rows.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PLACES)
    rows = written(rows.join(sizes, "component").drop("size"), "large")
    means = written(_means(rows), "means")
    radii = _angles(rows.join(means, ["component", "width"])).groupBy("component").agg(F.max("angle").alias("radius"))
    means = written(means.join(radii, "component"), "centers")
    blocks = max(1, math.ceil(means.count() / (4 * SMALL)))
    dealt = means.withColumn("own", F.pmod(F.xxhash64("component"), F.lit(blocks)).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def near(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame["own"] == frame["low"]], frame[frame["own"] == frame["high"]]
        angle = np.arccos(np.clip(_matrix([*left["m"], *right["m"]])[:len(left)] @ _matrix([*left["m"], *right["m"]])[len(left):].T, -1, 1))
        x, y, r, q, w, u = (f[c].to_numpy() for c in ("component", "radius", "width") for f in (left, right))
        good = (angle <= r[:, None] + q[None, :] + reach) & (w[:, None] == u[None, :]) & (x[:, None] != y[None, :])
        i, j = np.nonzero(good)
        return pd.DataFrame({"x": np.minimum(x[i], y[j]), "y": np.maximum(x[i], y[j])}).drop_duplicates()

    pairs = written(dealt.groupBy("low", "high").applyInPandas(near, "x long, y long"), "pairs")
    center = means.select(F.col("component").alias("facing"), "m", "radius")

    def side(own: str, other: str) -> DataFrame:
        met = pairs.select("x", "y", F.col(own).alias("component"), F.col(other).alias("facing")).join(center, "facing").join(rows.select("component", "id", "v"), "component")
        return written(_angles(met.select("x", "y", "id", "v", "radius", "m")).where(F.col("angle") <= F.col("radius") + reach).select("x", "y", "id", "v"), "facing")

    left, right = side("x", "y"), side("y", "x")
    count = lambda rows, name: rows.groupBy("x", "y").agg(F.ceil(F.count(F.lit(1)) / SMALL).cast("int").alias(name))
    number = written(count(left, "p").join(count(right, "q"), ["x", "y"]), "blocks")
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = left.join(number, ["x", "y"]).select("x", "y", mine("p").alias("i"), every("q").alias("j"), "id", "v", F.lit(True).alias("asks"))
    answers = right.join(number, ["x", "y"]).select("x", "y", every("p").alias("i"), mine("q").alias("j"), "id", "v", F.lit(False).alias("asks"))

    def closest(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = frame[frame["asks"]], frame[~frame["asks"]]
        if len(a) and len(b):
            dots = _matrix(a["v"]) @ _matrix(b["v"]).T
            i, j = np.unravel_index(dots.argmax(), dots.shape)
            if dots[i, j] >= threshold:
                return pd.DataFrame({"a": [a["id"].iloc[i]], "b": [b["id"].iloc[j]]})
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})

    return asks.unionByName(answers).groupBy("x", "y", "i", "j").applyInPandas(closest, "a long, b long")


def count_links(vectors: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(id, n_links): for vectors in components, the exact number of other vectors linked, copies counted."""
    spread = math.acos(threshold)
    rows = vectors.join(labels, vectors["id"] == labels["node"]).select("id", "v", "copies", "component")
    sizes = rows.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = written(rows.join(sizes, "component"), "members")

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        v, width = _matrix(frame["v"]), frame["v"].map(len).to_numpy()
        linked = ((v @ v.T) >= threshold) & (width[:, None] == width[None, :])
        np.fill_diagonal(linked, False)
        return pd.DataFrame({"id": frame["id"], "n_links": (linked * frame["copies"].to_numpy()[None, :]).sum(axis=1)})

    small = rows.where(F.col("size") <= SMALL).select("component", "id", "v", "copies").groupBy("component").applyInPandas(whole, "id long, n_links long")

    large = rows.where(F.col("size") > SMALL)
    means = _means(large)
    placed = large.withColumn("width", F.length("v").cast("long")).join(means, ["component", "width"])

    def angle(batches):
        for batch in batches:
            v, m = _matrix(batch.column("v").to_pylist()), _matrix(batch.column("m").to_pylist())
            core = np.arccos(np.clip((v * m).sum(axis=1), -1, 1)) <= spread / 2 - 1e-6
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("component", "width", "id", "v", "copies")] + [pa.array(core)], names=["component", "width", "id", "v", "copies", "core"])

    placed = written(placed.mapInArrow(angle, "component long, width long, id long, v binary, copies long, core boolean"), "placed")
    counts = placed.groupBy("component", "width").agg(F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("inner"), F.sum((~F.col("core")).cast("long")).alias("outer"))
    placed = placed.join(counts, ["component", "width"])
    inside = placed.where("core").select("id", (F.col("inner") - F.col("copies")).alias("n_links"))
    # Only vectors outside the core are compared: each block of them with every vector of the component.
    blocks = F.greatest(F.lit(1), F.ceil(F.col("outer") / SMALL)).cast("int")
    queries = placed.where("not core").select("component", "width", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"), "id", "v", "copies", "core", F.lit(True).alias("asks"))
    answers = placed.where("outer > 0").select("component", "width", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "id", "v", "copies", "core", F.lit(False).alias("asks"))
    answers = answers.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    asked = queries.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))

    def against(frame: pd.DataFrame) -> pd.DataFrame:
        mine, others = frame[frame["asks"]], frame[~frame["asks"]]
        if not len(mine) or not len(others):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "n_links": np.zeros(0, np.int64)})
        linked = (_matrix(mine["v"]) @ _matrix(others["v"]).T >= threshold) & (mine["id"].to_numpy()[:, None] != others["id"].to_numpy()[None, :])
        out = pd.DataFrame({"id": mine["id"], "n_links": linked @ others["copies"].to_numpy()})
        # The inner vectors have not counted their outer partners yet.
        inner = others["core"].to_numpy()
        back = pd.DataFrame({"id": others["id"][inner], "n_links": mine["copies"].to_numpy() @ linked[:, inner]})
        return pd.concat([out, back])

    outside = asked.unionByName(answers).groupBy("component", "width", "block", "part").applyInPandas(against, "id long, n_links long")
    return small.unionByName(inside).unionByName(outside).groupBy("id").agg(F.sum("n_links").alias("n_links"))


def near_duplicates(rows: DataFrame, *, id_column: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector."""
    every = written(unit_vectors(rows, id_column, column).dropDuplicates(["id", "digest"]), "unit")
    classes = every.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    named = every.join(classes, "digest", "left").select("id", "rep", "copies", "v")
    vectors = written(named.where("id = rep").select("id", "v", "copies"), "vectors")
    size = vectors.count()
    parts = max(partitions_of(rows), 2 * rows.sparkSession.sparkContext.defaultParallelism, size // 20_000)
    graph, held = None, None
    for attempt in range(AUDITS):
        met = _meet(vectors, parts, size, 17 + attempt)
        graph = written(_merge(met if graph is None else graph.unionByName(met), parts, threshold), "met")
        graph = refine(graph, vectors, parts, threshold, ROUNDS if attempt == 0 else 2)
        # No link found once is lost again when lists are trimmed.
        new = threshold_links(graph, vectors, threshold)
        held = written(new if held is None else held.unionByName(new), "links")
        labels = written(components(held), "labels")
        held = written(held.unionByName(links_across(vectors, labels, threshold)), "links")
        labels = written(components(held), "labels")
        seen = written(audit(vectors, labels, threshold, attempt), "audit")
        short = short_strata(seen)
        missed = seen.where("missed").select("a", "b")
        if not missed.isEmpty():
            held = written(held.unionByName(missed), "links")
            labels = written(components(held), "labels")
        if not short:
            break
    else:
        raise RuntimeError(f"near duplicates: the last audit found too many vectors with missed links (stratum, vectors, short): {short}")
    links = count_links(vectors, labels, threshold)
    out = named.join(labels.withColumnRenamed("node", "rep"), "rep", "left").join(links.withColumnRenamed("id", "rep"), "rep", "left")
    found = F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    component = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias("vec_id"), found.cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
