"""Product-quantised codes of vectors with exact integer arithmetic; the nearest entry of a part is searched with LAESA pivots.

Every component x becomes floor(256 * x). A vector is cut into ``parts`` equal consecutive parts, and every part position has a
codebook of up to ``entries`` entries: at first the parts of the vectors with the smallest ids. A round assigns every part to
its nearest entry (squared Euclidean distance, the lower index in a tie) and replaces each used entry by the floored mean of
its parts.

The search. A few first entries of a position are its fixed *pivots*, chosen far from one another. Each part's distance to them
is computed once, when the integers are written; a round computes the distances of its entries to the pivots. The largest
difference of two such distances is a lower bound of the distance from part to entry (triangle inequality), less a margin
for rounding. Entries are taken in the order of their bounds and compared in exact integers until the next bound exceeds the
best distance found: nothing that could win, or tie, is left out.

Rows are only read and written in place; from a round, a partition sends one row of sums per used entry, so what is shuffled is
bounded by partitions * parts * entries and the driver gets the codebooks alone. Label sums go back by a broadcast if
their measured bytes are few, else by a join that deals out hot labels.

Dropped are vectors that are null or hold null or non-finite components, and those whose length is not that of the kept
vector with the smallest id, or not a multiple of ``parts`` above 0: they have no place in the codebooks. A component of
2 ** 19 or more is an error, as squared distances would not fit a long. Fewer rows than entries make smaller codebooks. Repeated ids are rows of their own; among
them the smaller vector comes first. Null ids come last, null labels are one label. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.llm.common import written
from lendloom.operators.skew import broadcast_if_small, enrich, hot_keys, spread

PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
SCALE, MOST = 256, 1 << 27
ROWS_AT_ONCE = 4096
#: Relative rounding of a stored distance (32-bit floats keep 24 bits).
ROUNDING = 1e-6


def whole(vectors: np.ndarray) -> np.ndarray:
    numbers = np.floor(SCALE * vectors.astype(np.float64))
    if numbers.size and np.abs(numbers).max() >= MOST:
        raise ValueError(f"a component of {MOST // SCALE} or more")
    return numbers.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    step = a - b
    return (step * step).sum(-1)


def choose_pivots(book: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries of one position far from each other: the first, then always the one with the largest sum of distances to those chosen."""
    chosen, total = [0], np.zeros(len(book))
    while len(chosen) < min(count, len(book)):
        total += np.sqrt(squared(book, book[chosen[-1]]))
        left = total.copy()
        left[chosen] = -1
        chosen.append(int(left.argmax()))
    return book[chosen]


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of (rows, d) parts to the pivots of their position, once for all rounds."""
    return np.sqrt(squared(parts[:, None], pivots[None])).astype(np.float32)


def nearest(parts: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry, its squared distance, and how many distances were evaluated."""
    between = np.sqrt(squared(pivots[:, None], book[None]))
    bound = np.zeros((len(parts), len(book)))
    for k in range(len(pivots)):
        mine = to_pivots[:, k, None].astype(np.float64)
        np.maximum(bound, np.abs(mine - between[k]) - ROUNDING * (mine + between[k]), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = bound * bound * (1 - ROUNDING)
    best, who = np.full(len(parts), np.iinfo(np.int64).max), np.full(len(parts), len(book))
    active, evaluated = np.arange(len(parts)), 0
    for rank in range(len(book)):
        entry = order[active, rank]
        open_ = bound[active, entry] <= best[active]
        active, entry = active[open_], entry[open_]
        if not len(active):
            break
        evaluated += len(active)
        distance = squared(parts[active], book[entry])
        better = (distance < best[active]) | ((distance == best[active]) & (entry < who[active]))
        best[active[better]], who[active[better]] = distance[better], entry[better]
    return who, best, evaluated


def assign(numbers: np.ndarray, to_pivots: np.ndarray, books: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries (rows, parts) and squared distances of (rows, parts, d) numbers."""
    found = [nearest(numbers[:, p], to_pivots[:, p], books[p], pivots[p])[:2] for p in range(len(books))]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _numbers(column: pa.Array, shape: tuple, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _blocks(batch: pa.RecordBatch):
    for low in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(low, ROWS_AT_ONCE)


def compress(
    vectors: DataFrame, *, id_column: str = "vec_id", column: str = "embedding", label: str | None = None,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray | None]:
    """(id, code, error[, label]) and the final codebooks as an array (parts, entries, d); no codebooks without a vector to keep."""
    names = [id_column, *([label] if label else [])]
    vector = F.col(column).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    length = F.size(vector)
    kept = vectors.select(*names, vector.alias("_v")).where(vector.isNotNull() & fine & (length > 0) & (length % parts == 0))
    output = T.StructType([vectors.schema[id_column], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), *([vectors.schema[label]] if label else [])])
    by_id = (F.col(id_column).asc_nulls_last(), F.col("_v"))
    first = kept.orderBy(*by_id).select(F.size("_v")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], output), None
    size = first[0]
    d = size // parts
    kept = kept.where(F.size("_v") == size)
    # At most ``entries`` rows.
    starts = whole(np.array([r[0] for r in kept.orderBy(*by_id).select("_v").limit(entries).collect()])).reshape(-1, parts, d)
    books = starts.transpose(1, 0, 2)
    fixed = np.stack([choose_pivots(b, pivots) for b in books])
    n_pivots = fixed.shape[1]

    def measure(batches):
        for batch in batches:
            for some in _blocks(batch):
                numbers = whole(some.column("_v").flatten().to_numpy(zero_copy_only=False)).reshape(some.num_rows, parts, d)
                distances = np.stack([pivot_distances(numbers[:, p], fixed[p]) for p in range(parts)], 1)
                rows = zip(numbers.astype("<i4"), distances.astype("<f4"))
                packed = [(a.tobytes(), b.tobytes()) for a, b in rows]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(n) for n in names), pa.array([a for a, _ in packed], pa.binary()), pa.array([b for _, b in packed], pa.binary())],
                    names=[*names, "_numbers", "_distances"])

    measured = T.StructType([*(vectors.schema[n] for n in names), T.StructField("_numbers", T.BinaryType()), T.StructField("_distances", T.BinaryType())])
    held = written(spread(kept).mapInArrow(measure, measured), "vector-parts")

    def found(some, book):
        numbers = _numbers(some.column("_numbers"), (parts, d), "<i4").astype(np.int64)
        return numbers, *assign(numbers, _numbers(some.column("_distances"), (parts, n_pivots), "<f4"), book, fixed)

    def sums(book):
        def step(batches):
            total, count = np.zeros((parts * book.shape[1], d), np.int64), np.zeros(parts * book.shape[1], np.int64)
            shift = np.arange(parts) * book.shape[1]
            for batch in batches:
                for some in _blocks(batch):
                    numbers, who, _ = found(some, book)
                    slot = (who + shift).ravel()
                    count += np.bincount(slot, minlength=len(count))
                    np.add.at(total, slot, numbers.reshape(-1, d))
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array(count[used]), *(pa.array(np.ascontiguousarray(total[used, k])) for k in range(d))],
                names=["slot", "n", *(f"s{k}" for k in range(d))])

        return step

    numbered = "slot long, n long, " + ", ".join(f"s{k} long" for k in range(d))
    for _ in range(rounds):
        moved = held.select("_numbers", "_distances").mapInArrow(sums(books), numbered).groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(d)))
        books = books.copy()
        # At most parts * entries rows.
        for row in moved.collect():
            books[divmod(row["slot"], books.shape[1])] = [row[f"s{k}"] // row["n"] for k in range(d)]
    final = books

    def code(batches):
        for batch in batches:
            for some in _blocks(batch):
                _, who, distance = found(some, final)
                text = pa.array([bytes(row).hex() for row in who.astype(np.uint8)] if final.shape[1] <= 256 else ["".join(f"{e:02x}" for e in row) for row in who.tolist()], pa.string())
                columns = {id_column: some.column(id_column), "code": text, "error": pa.array(distance.sum(1))}
                yield pa.RecordBatch.from_pydict(columns | ({label: some.column(label)} if label else {}))

    return held.mapInArrow(code, output), final


def codebook_digest(books: np.ndarray) -> str:
    """Hex SHA-256 of all components by part, entry and place, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame, label: str) -> DataFrame:
    """Add ``label_error``: the error summed over the rows with an equal label, null being one label."""
    key = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))
    codes = written(codes.withColumn("_key", key), "codes")
    totals = written(codes.groupBy("_key").agg(F.sum("error").alias("label_error")), "label-errors")
    small = broadcast_if_small(totals)
    joined = codes.join(small, "_key") if small is not totals else enrich(codes, totals, "_key", "inner", hot=hot_keys(codes, "_key"))
    return joined.drop("_key")
