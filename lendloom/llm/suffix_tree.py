"""A probabilistic suffix tree over the words of texts.

Texts are lower-cased (A-Z) and cut into words at ASCII white space, each text closed by an end word. The empty context is the
word-unigram model over all training words, ``(c + 0.5) / (N + 0.5 (V + 1))``, with all unseen words as one. Longer contexts
are grown word by word. A string of words is kept if it was seen ``least_count`` times, whatever the size of the corpus; a string
can only be kept if the strings without its first and without its last word are. So the tree grows with the corpus, and no task
and not the driver holds it: the counts cover the whole corpus and lie in tables dealt by key.

A context (a kept string with kept continuations) is retained if its next-word distribution diverges from that of its longest
retained suffix: the code length it saves on the training words, its count times the divergence, must exceed
``bits_per_entry`` for every continuation it stores. A retained state takes ``discount`` from the count of each continuation;
what is left goes to all other words in the proportions of its longest retained suffix, so every state sums to one. A word is
scored in the state of the longest retained suffix of the words before it.

Texts are first stored as blocks: words as numbers into the block's own word list. For each length, one shuffle by key adds up
the blocks' counts, and the sums that decide on contexts, and hands every block what it must know of the strings that occur in
it. So no task needs the whole vocabulary or the whole tree. An answer has no keys: a block finds its own again, and takes the
numbers in their order. Numbers travel as planes of bytes, and the shuffle files of a step go when it ends.

Null texts are empty: the end word alone. Repeated rows count each. Output columns are fixed; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import batches_of, freed, freed_once, gathered, mix, of_planes, planes, shuffles_dropped, slices, word_hashes, written

DEPTH = 3
LEAST_COUNT = 4
BITS_PER_ENTRY = 6.0
DISCOUNT = 0.75
BLOCK_WORDS, BUCKET_WORDS = 1_000_000, 2_000_000
END_WORD = np.uint64(0x1F83D9ABFB41BD6B)
_STEP = np.uint64(0x9E3779B97F4A7C15)
BLOCKS = "block long, ids array<long>, held array<boolean>, sizes array<int>, codes binary, words binary, counts binary"
ASKED = "block long, bucket int, keys binary, counts binary, contexts binary, sums binary"
TOLD = "block long, step int, bucket int, counts binary, spares binary, n long, v long"
_TOLD = pa.schema([("block", pa.int64()), ("step", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("counts", "spares")), ("n", pa.int64()), ("v", pa.int64())])


# ---------------------------------------------------------------- blocks of texts

def text_blocks(docs: DataFrame, id_column: str, column: str, held: str) -> DataFrame:
    """One row per block of about ``BLOCK_WORDS`` words; ``counts`` are those of the block's rows that are not held out."""

    def block(batches):
        from pyspark import TaskContext

        ids, flags, sizes, words, number, count = [], [], [], [], 0, 0

        def flush():
            distinct, codes = np.unique(np.concatenate(words), return_inverse=True)
            trained = np.repeat(~np.array(flags, bool), sizes)
            counts = np.bincount(codes[trained], minlength=len(distinct))
            return pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 20) + number]), pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([zlib.compress(planes(codes.astype(np.uint32)), 1)], pa.binary()), pa.array([planes(distinct)], pa.binary()), pa.array([planes(counts.astype(np.int32))], pa.binary())],
                names=["block", "ids", "held", "sizes", "codes", "words", "counts"])

        for batch in batches:
            owner, out = batch.column(id_column).cast(pa.int64()).to_pylist(), batch.column(held).to_pylist()
            for low, high, data, bounds in slices(batch.column(column)):
                hashes, begins = word_hashes(data, bounds)
                words.append(np.insert(hashes, begins[1:], END_WORD))
                count += len(words[-1])
                sizes.extend((np.diff(begins) + 1).tolist())
                ids.extend(owner[low:high])
                flags.extend(out[low:high])
                if count > BLOCK_WORDS:
                    yield flush()
                    ids, flags, sizes, words, count = [], [], [], [], 0
                    number += 1
        if ids:
            yield flush()

    return docs.select(id_column, column, held).mapInArrow(freed(block), BLOCKS)


def _filled(x: np.ndarray, mask: np.ndarray) -> bytes:
    """The columns of ``x`` under the mask, and the mask."""
    return len(mask).to_bytes(4, "little") + np.packbits(mask).tobytes() + planes(x[..., mask])


def _of_filled(parts, kind, fill, rows: int = 1) -> np.ndarray:
    """The arrays of several such byte strings, end to end, with ``fill`` outside the masks."""
    out = [np.zeros((rows, 0), kind)]
    for x in parts:
        n = int.from_bytes(x[:4], "little")
        end = 4 + -(-n // 8)
        whole = np.full((rows, n), fill, kind)
        whole[:, np.unpackbits(np.frombuffer(x[4:end], np.uint8), count=n).view(bool)] = of_planes([x[end:]], kind).reshape(rows, -1)
        out.append(whole)
    return np.concatenate(out, axis=1)


def _codes(packed: bytes) -> np.ndarray:
    return of_planes([zlib.decompress(packed)], np.uint32)


# ---------------------------------------------------------------- growing the tree

class Level:
    """Kept strings of one length: sorted keys, counts, and the probability of the last word after the others; ``first`` on those
    that a block answers for.

    As contexts, ``spare`` is the factor for words that are not stored, NaN where the context is not retained.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.float64)
        self.chance = np.full(len(keys), np.nan)
        self.spare = np.full(len(keys), np.nan)
        self.first = np.ones(len(keys), bool)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it is not kept."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1).astype(np.int32)


def _longer(key: np.ndarray, at: np.ndarray, words: np.ndarray, ended: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a string that is one word longer than those of ``key`` ends, and its key there: both strings in it must be kept."""
    able = np.zeros(len(words), bool)
    able[1:] = (at[:-1] >= 0) & ~ended[:-1] & (at[1:] >= 0)
    where = np.flatnonzero(able)
    return where, mix(key[where - 1] * _STEP + words[where])


def strings(words: np.ndarray, at: np.ndarray, levels: list[Level]):
    """For lengths 1, 2, ...: (key, place among the kept, -1 if none) of the string that ends at each word. After the last level
    come the candidates that are one word longer, with place -2. ``at`` are the places of the words themselves."""
    key = words
    yield key, at
    ended = words == END_WORD
    for level in [*levels[1:], None]:
        where, keys = _longer(key, at, words, ended)
        grown, place = np.zeros(len(words), np.uint64), np.full(len(words), -1, np.int32)
        grown[where] = keys
        place[where] = level.find(grown[where]) if level is not None else -2
        key, at = grown, place
        yield key, at


def _state(whole, stored, before, entries, seen, saved, bits_per_entry: float) -> np.ndarray:
    """The spare factor of contexts from the sums over their continuations, NaN where a context is not retained."""
    left, rest = 1 - stored, np.maximum(1 - before, 1e-12)
    with np.errstate(divide="ignore", invalid="ignore"):
        saved = saved + np.where(whole > seen, (whole - seen) * np.log2(left / rest), 0.0)
    return np.where((entries > 0) & (saved > bits_per_entry * entries) & (left > 0), left / rest, np.nan)


def _sums(own, parent, n, context, size: int) -> list[np.ndarray]:
    """Per context: what its continuations store, what they had before, their number, their count, and the bits they save."""
    return [np.bincount(context, w, minlength=size) for w in (own, parent, np.ones(len(n)), n, n * np.log2(own / parent))]


def retain(upper: Level, lower: Level, context: np.ndarray, suffix: np.ndarray, bits_per_entry: float, discount: float) -> None:
    """Decide which strings of ``upper`` are states, from all their continuations in ``lower``; set its chances and ``upper``'s spare."""
    own, parent = (lower.counts - discount) / upper.counts[context], upper.chance[suffix]
    upper.spare = _state(upper.counts, *_sums(own, parent, lower.counts, context, len(upper.keys)), bits_per_entry)
    lower.chance = np.where(np.isnan(upper.spare[context]), parent, own)


def _local(table: pa.Table, told: pa.Table, least: int, length: int):
    """A block's words, their places among its own, all training counts of the latter, the kept strings of up to ``length`` words
    that occur in it, and for each length (key, place among the kept, -1 if none) of the string that ends at each word."""
    codes, own = _codes(table.column("codes")[0].as_py()), of_planes(table.column("words").to_pylist(), np.uint64)
    told = told.sort_by([("step", "ascending"), ("bucket", "ascending")])
    step = told.column("step").to_numpy()
    part = lambda c, k: told.column(c).filter(pa.array(step == k)).to_pylist()

    def level(keys: np.ndarray, size: int):
        """The kept ones of a block's strings of a length, and the place of each string among them."""
        told_counts = _of_filled(part("counts", size), np.int64, 0)[0]
        counts = told_counts >> 1
        good = counts >= least
        made = Level(keys[good], counts[good])
        made.first = (told_counts[good] & 1).astype(bool)
        spares = _of_filled(part("spares", size + 2), np.float64, np.nan)[0]
        if len(spares):
            made.spare = spares
        return made, np.where(good, np.cumsum(good) - 1, -1).astype(np.int32), counts

    words = own[codes]
    first, places, counts = level(own, 1)
    levels, found, ended = [first], [(words, places[codes])], words == END_WORD
    for size in range(2, length + 1):
        where, keys = _longer(*found[-1], words, ended)
        distinct, code = np.unique(keys, return_inverse=True)
        kept, places, _ = level(distinct, size)
        grown, at = np.zeros(len(words), np.uint64), np.full(len(words), -1, np.int32)
        grown[where], at[where] = keys, places[code]
        levels.append(kept)
        found.append((grown, at))
    return words, codes, counts, levels, found


def _learn(found: list, levels: list[Level], n: int, v: int, discount: float) -> list[tuple[np.ndarray, ...]]:
    """Set the chances of a block's kept strings; (own chance, parent's chance, context) of those of two words and more."""
    levels[0].chance = (levels[0].counts + 0.5) / (n + 0.5 * (v + 1))
    out = []
    for upper, lower, (_, above), (_, at) in zip(levels, levels[1:], found, found[1:]):
        where, place = np.flatnonzero(at >= 0), np.zeros(len(lower.keys), np.int64)
        place[at[where]] = where
        context, suffix = above[place - 1], above[place]
        own, parent = (lower.counts - discount) / upper.counts[context], upper.chance[suffix]
        lower.chance = np.where(np.isnan(upper.spare[context]), parent, own)
        out.append((own, parent, context))
    return out


def _asked(block: int, keys, counts, contexts, sums, buckets: int) -> pa.Table:
    """A block's strings with their counts, and its contexts with their sums, one row per bucket; keys are sorted, and a bucket is
    a range of them."""
    def cuts_of(k):
        return np.searchsorted(((k >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))

    cuts, bounds, counts = cuts_of(keys), cuts_of(contexts), counts.astype(np.int32)
    used = [i for i in range(buckets) if cuts[i] < cuts[i + 1] or bounds[i] < bounds[i + 1]]
    cut = lambda x, at: pa.array([planes(x[at[i]:at[i + 1]]) for i in used], pa.binary())
    some = (sums != 0).any(axis=0)
    filled = pa.array([_filled(sums[:, bounds[i]:bounds[i + 1]], some[bounds[i]:bounds[i + 1]]) for i in used], pa.binary())
    return pa.table([pa.array([block] * len(used), pa.int64()), pa.array(used, pa.int32()), cut(keys, cuts), cut(counts, cuts), cut(contexts, bounds), filled],
                    names=["block", "bucket", "keys", "counts", "contexts", "sums"])


def _answered(asked: DataFrame, step: int, buckets: int, least: int, bits_per_entry: float) -> DataFrame:
    """What blocks asked, added up by key: to each block go, in the order in which it asked, the totals of its strings (0 if they
    were not seen ``least`` times), doubled and one more in the first block of a string, and the spare factors of its contexts. A
    key has one place per block, so none is hot."""

    def total(batches):
        if (table := gathered(batches)) is None:
            return
        bucket = table.column("bucket").to_numpy()
        for one in np.unique(bucket):  # several may meet in a task: their sums are made one after another
            yield from answers(table.filter(pa.array(bucket == one)).sort_by("block"), one)

    def answers(table, bucket):
        block = table.column("block").to_numpy()
        part = lambda c, kind: [of_planes([x], kind) for x in table.column(c).to_pylist()]
        keys, contexts = part("keys", np.uint64), part("contexts", np.uint64)
        cuts, bounds = (np.cumsum([0, *map(len, x)]) for x in (keys, contexts))
        distinct, begin, code = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        totals = np.bincount(code, np.concatenate(part("counts", np.int32)), minlength=len(distinct)).astype(np.int64)[code]
        first = np.zeros(len(totals), bool)
        first[begin] = True
        del keys, distinct, begin, code
        distinct, code = np.unique(np.concatenate(contexts), return_inverse=True)
        sums = _of_filled(table.column("sums").to_pylist(), np.float64, 0, 6)
        spare = _state(*(np.bincount(code, x, minlength=len(distinct)) for x in sums), bits_per_entry)[code]
        del contexts, distinct, code, sums
        rows, held = [], 0
        for i, at in enumerate(block):
            a, b = slice(cuts[i], cuts[i + 1]), slice(bounds[i], bounds[i + 1])
            counted = totals[a][first[a]]
            kept = np.where(totals[a] >= least, totals[a], 0)
            rows.append((at, step, bucket, _filled(2 * kept + first[a], kept > 0), _filled(spare[b], ~np.isnan(spare[b])), counted.sum(), (counted > 0).sum()))
            held += 8 * (cuts[i + 1] - cuts[i]) + 8 * (bounds[i + 1] - bounds[i])
            if held > 1 << 22 or i + 1 == len(block):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _TOLD)], schema=_TOLD)
                rows, held = [], 0

    return asked.repartition(buckets, "bucket").mapInArrow(freed(total), TOLD)


def grow(blocks: DataFrame, *, depth: int = DEPTH, least_count: int = LEAST_COUNT, bits_per_entry: float = BITS_PER_ENTRY, discount: float = DISCOUNT) -> tuple[DataFrame, int, int]:
    """What every block must know of the kept strings of 1 to ``depth`` + 1 words that occur in it, the number of training words
    and of different ones. Step k counts strings of k words and decides on contexts of k - 2."""
    spark = blocks.sparkSession
    words = blocks.agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)"))).first()[0] or 0
    buckets = max(2 * spark.sparkContext.defaultParallelism, words // BUCKET_WORDS)
    nothing = np.zeros(0, np.uint64), np.zeros((6, 0))

    def words_of(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own, n = of_planes([batch.column("words")[i].as_py()], np.uint64), of_planes([batch.column("counts")[i].as_py()], np.int32)
                yield from _asked(batch.column("block")[i].as_py(), own, n, *nothing, buckets).to_batches()

    with batches_of(spark, 1):
        asked = blocks.select("block", "words", "counts").mapInArrow(freed(words_of), ASKED)
        told = written(_answered(asked, 1, buckets, 0, bits_per_entry), "told")
    row = told.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = row["n"] or 0, row["v"] or 0

    def asking(step: int):
        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            words, _, _, levels, found = _local(left, right, least_count, min(step - 1, depth + 1))
            keys, counts, contexts, sums = nothing[0], np.zeros(0), *nothing
            if step <= depth + 1:
                held, sizes = (left.column(c)[0].values.to_numpy(zero_copy_only=False) for c in ("held", "sizes"))
                where, keys = _longer(*found[-1], words, words == END_WORD)
                keys, code = np.unique(keys, return_inverse=True)
                counts = np.bincount(code, np.repeat(~held.astype(bool), sizes)[where], minlength=len(keys))
            if step > 2:
                chance, parent, context = _learn(found, levels[:step - 1], n, v, discount)[-1]
                upper, lower = levels[step - 3], levels[step - 2]
                mine = lower.first
                contexts = upper.keys
                sums = np.array([np.where(upper.first, upper.counts, 0), *_sums(chance[mine], parent[mine], lower.counts[mine], context[mine], len(upper.keys))])
            return _asked(left.column("block")[0].as_py(), keys, counts, contexts, sums, buckets)

        return ask

    for step in range(2, depth + 3):
        asked = blocks.select("block", "held", "sizes", "codes", "words").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(freed_once(asking(step)), ASKED)
        with batches_of(spark, 64):
            told = told.unionByName(written(_answered(asked, step, buckets, least_count, bits_per_entry), "told"))
    return told, n, v


def chances(words: np.ndarray, at: np.ndarray, base: np.ndarray, levels: list[Level], found: list | None = None) -> np.ndarray:
    """Probability of each word in the state of the longest retained suffix before it; ``base`` are the unigram ones and ``at``
    the places of the words in the first level."""
    found = [place for _, place in found or strings(words, at, levels)]
    chance = base.copy()
    ended = words == END_WORD
    for upper, lower, context, entry in zip(levels, levels[1:], found, found[1:]):
        before = np.full(len(words), -1, np.int32)
        before[1:] = np.where(ended[:-1], -1, context[:-1])
        spare = np.where(before >= 0, upper.spare[np.maximum(before, 0)], np.nan) if len(upper.keys) else np.full(len(words), np.nan)
        state = ~np.isnan(spare)
        stored = state & (entry >= 0)
        chance = np.where(stored, lower.chance[np.maximum(entry, 0)] if len(lower.keys) else chance, np.where(state, chance * spare, chance))
    return chance


# ---------------------------------------------------------------- scores

def score(docs: DataFrame, *, id_column: str = "doc_id", column: str = "text", held: str = "held_out", depth: int = DEPTH, least_count: int = LEAST_COUNT,
          bits_per_entry: float = BITS_PER_ENTRY, discount: float = DISCOUNT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row, learned from the rows not held out."""
    blocks = written(text_blocks(docs, id_column, column, held), "blocks")
    with shuffles_dropped(docs.sparkSession):
        told, n, v = grow(blocks, depth=depth, least_count=least_count, bits_per_entry=bits_per_entry, discount=discount)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        words, codes, counts, levels, found = _local(left, right, least_count, depth + 1)
        _learn(found, levels, n, v, discount)
        c = counts[codes]
        sizes = np.array(left.column("sizes")[0].values, np.int64)
        begins = np.cumsum(sizes) - sizes
        base = (c + 0.5) / (n + 0.5 * (v + 1))
        return pa.table({
            "doc_id": left.column("ids")[0].values, "held_out": left.column("held")[0].values, "n_tokens": sizes,
            "n_known": np.add.reduceat((c > 0).astype(np.int64), begins), "train_tokens": np.full(len(sizes), n, np.int64),
            "base_score": np.add.reduceat(np.log10(base), begins), "score": np.add.reduceat(np.log10(chances(words, None, base, levels, found)), begins),
        })

    return blocks.drop("counts").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        freed_once(finish), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
