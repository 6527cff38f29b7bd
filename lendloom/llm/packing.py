"""Pack tokenised documents into as few sequences of at most ``capacity`` tokens as possible.

Documents are tokenised where they are read; only a document of more than ``capacity`` tokens is cut, into full pieces and a
rest. Pieces are dealt at random to groups of about ``GROUP_ITEMS``, so a group looks like the whole and its last open bin is
a few ten-thousandths of its bins. Each group is solved by a grouping genetic algorithm on several islands, tasks of their own:
a chromosome is a set of bins; crossover injects whole well-filled bins of one parent into the other, drops the bins that
then hold a document twice, and places the displaced documents by best fit; mutation empties poorly filled bins. After each epoch
the elite of an island migrates to the next one in a ring. The best chromosome of a group is its packing.

Null and empty texts are one end token. Repeated rows are packed as often as they occur. Columns of the input that clash with
the output are dropped.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import LOWER_TABLE, freed, slices, written

CAPACITY = 2048
END_ID = 0
GROUP_ITEMS = 4096
ISLANDS, EPOCHS, CHILDREN, POPULATION = 2, 2, 24, 4
SLICE_BYTES = 1 << 20
CACHED_WORDS = 500_000


class Lists:
    """Growing lists of ids, numbered by a key."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def add(self, keys: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        base = len(self.known)
        self.known.update(zip(keys, range(base, base + len(keys))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, ids])

    def get(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end, and where each key's ids end."""
        codes = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[codes] - (ends - sizes), sizes) + np.arange(total)], ends


LETTERS = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
MARKS = rb"[!-&(-/:-;=?-@\[-`{-~]*"
SIMPLE = re.compile(rb"(%s)(%s)(%s)" % (MARKS, LETTERS, MARKS))
UNIT = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|(?!<\|)[!-&(-/:-;=?-@\[-`{-~]+")
#: The letter that byte-level tokenizers show for a byte: itself if printable, else the next one from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = dict(zip([b for b in range(256) if b not in set(_SHOWN)], range(256, 512)))


#: Kinds of bytes of plain texts: white space, letters, marks, digits. A text with any other byte is not plain; in one that is,
#: bytes from 0x80 on follow 0xC3 and make a Latin letter.
SPACE, LETTER, MARK, DIGIT, OTHER = range(5)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[*b" \t\n\x0b\x0c\r"]] = SPACE
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7))]] = LETTER
KINDS[[b for b in range(0x21, 0x7F) if KINDS[b] == OTHER and b not in b"'<>0123456789"]] = MARK
KINDS[[*b"0123456789"]] = DIGIT
PLAIN_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A or 0x80 <= b <= 0x9E else b for b in range(256)], np.uint8)
#: What normalizes, parts and merges in the only kind of file that plain texts are merged apart for.
PLAIN_FORM = (
    ["NFC", {"Regex": r"\s+"}, "Lowercase"],
    {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
)


class PlainMerges:
    """Token ids of plain texts by the byte merging of tiktoken, which has no suffix at the end of a unit: a zero byte stands for it.

    If every entry of the vocabulary is what its own text encodes to, merging the pair whose union has the lowest id gives the
    same ids as the listed merges (as in ``token_alignment.ByteLevel``); the entries of one byte and the suffix come before all merges.
    """

    def __init__(self, vocabulary: dict[str, int]):
        import tiktoken

        letters = {chr(n): b for b, n in (dict(zip(_SHOWN, _SHOWN)) | BYTE_LETTERS).items()}
        ranks = {bytes(letters[c] for c in p.removesuffix("</w>")) + b"\0" * p.endswith("</w>"): i for p, i in vocabulary.items()}
        self.merged = tiktoken.Encoding("plain", pat_str=r"[^\x00\t-\r ]+\x00", mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> PlainMerges | None:
        """None if the file has another form than this class knows, or an entry that its own text does not encode to."""
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        model, steps = form["model"], form["normalizer"].get("normalizers", []) if form["normalizer"] else []
        parts = (form["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = (
            [s["pattern"] if s["type"] == "Replace" else s["type"] for s in steps], parts[0].get("pattern") if parts else None,
            {k: v for k, v in model.items() if k not in ("vocab", "merges")},
        )
        vocabulary = model.get("vocab", {})
        if known != PLAIN_FORM or [p["type"] for p in parts] != ["Split", "ByteLevel"] or parts[1]["use_regex"] or parts[1]["add_prefix_space"] or form["post_processor"]:
            return None
        ends = [p for p, i in vocabulary.items() if i < 512 and p.endswith("</w>")]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        if len(ends) != 256 or [vocabulary["".join(m)] for m in merges] != list(range(512, len(vocabulary))):
            return None
        inside, ending = BPE(vocabulary, merges), BPE(vocabulary, merges, end_of_word_suffix="</w>")
        own = ([t.id for t in (ending.tokenize(p.removesuffix("</w>")) if p.endswith("</w>") else inside.tokenize(p))] == [i] for p, i in vocabulary.items())
        return cls(vocabulary) if all(own) else None

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray | None]:
        """Ids of each text, None for texts that are not plain."""
        if not len(data):
            return [np.zeros(0, np.uint32)] * (len(bounds) - 1)
        kinds = KINDS[data]
        other = np.zeros(len(bounds) - 1, bool)
        other[np.searchsorted(bounds, np.flatnonzero(kinds == OTHER), "right") - 1] = True
        ends = kinds == DIGIT
        ends[:-1] |= kinds[:-1] != kinds[1:]
        ends[bounds[1:][bounds[1:] > 0] - 1] = True
        ends &= kinds != SPACE
        before = np.cumsum(ends, dtype=np.int64)
        marked = np.zeros(len(data) + int(before[-1]), np.uint8)
        marked[np.arange(len(data)) + before - ends] = PLAIN_LOWER[data]
        raw, cuts = marked.tobytes(), (bounds + np.concatenate([[0], before])[bounds]).tolist()
        encode = self.merged.encode_to_numpy
        return [None if skip else encode(raw[a:b].decode(), disallowed_special=()) for skip, a, b in zip(other.tolist(), cuts, cuts[1:])]


class WordTokens:
    """Token ids of texts. Plain ones are merged whole; of others the ids are remembered per word while a task runs: the tokenizer
    never joins what white space parts.

    A word of Latin letters between ASCII marks is looked up in its three parts, which the tokenizer encodes apart too; any
    other word is encoded as it stands. A-Z is lower-cased first, as the tokenizer does, unless a control string may be meant.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), PlainMerges.of(path)
        self.forget()

    def forget(self) -> None:
        self.words, self.parts = Lists(), Lists()

    def _learn(self, words: list[bytes]) -> None:
        split = [[w] if w.isalpha() else [p for p in m.groups() if p] if (m := SIMPLE.fullmatch(w)) else [w] for w in words]
        flat = [p for s in split for p in s]
        new = list({p for p in flat if p not in self.parts.known})
        # Letters alone, or marks alone, are one unit of the tokenizer: they go straight to its model.
        encode = self.tokenizer.model.tokenize
        lists = [
            [t.id for t in encode(p.decode())] if p.isalpha()
            else [t.id for t in encode(p.lower().decode("latin-1").translate(BYTE_LETTERS))] if UNIT.fullmatch(p)
            else self.tokenizer.encode(p.decode(), add_special_tokens=False).ids
            for p in new
        ]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.parts.add(new, sizes, np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())))
        ids, ends = self.parts.get(flat)
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)]
        self.words.add(words, np.diff(upto), ids)

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of several texts end to end, and where each text's ids begin."""
        lists = self.plain.ids(data, bounds) if self.plain else [None] * (len(bounds) - 1)
        if rest := [i for i, own in enumerate(lists) if own is None]:
            ids, begins = self._by_word([data[bounds[i]:bounds[i + 1]].tobytes() for i in rest])
            for i, low, high in zip(rest, begins.tolist(), begins[1:].tolist()):
                lists[i] = ids[low:high]
        return np.concatenate([np.zeros(0, np.uint32), *lists]), np.cumsum([0, *map(len, lists)])

    def _by_word(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words.known) > CACHED_WORDS:
            self.words = Lists()
        if len(self.parts.known) > CACHED_WORDS:
            self.parts = Lists()
        # A word that may hold a control string stays as it is, or its capitals would turn into one.
        split = [[w if b"<|" in w else w.translate(LOWER_TABLE) for w in t.split()] if b"<|" in t else t.translate(LOWER_TABLE).split() for t in texts]
        words = [w for s in split for w in s]
        new = list({w for w in words if w not in self.words.known})
        if new:
            self._learn(new)
        ids, ends = self.words.get(words)
        upto = np.concatenate([[0], ends])
        return ids, upto[np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)]


_TOKENS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per worker process, so that its file is read once."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, *, id_column: str = "doc_id", column: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the tokens of every document plus an end token, cut at ``capacity``."""

    def tokenise(batches):
        words = word_tokens(tokenizer_path)
        try:
            for batch in batches:
                for low, high, data, bounds in slices(batch.column(column), SLICE_BYTES):
                    ids, begins = words.ids(data, bounds)
                    yield _cut(batch.column(id_column).slice(low, high - low), ids, begins, capacity, with_ids)
        finally:
            words.forget()  # a worker goes on to other tasks: what was learned here must not stay in its memory

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, column).mapInArrow(freed(tokenise), PIECES.format(kind=kind) + (", ids array<long>" if with_ids else ""))


def _cut(owners: pa.Array, ids: np.ndarray, begins: np.ndarray, capacity: int, with_ids: bool) -> pa.RecordBatch:
    rows, number, start, length, crc, lists = [], [], [], [], [], []
    end = np.array([END_ID], np.uint32)
    for i in range(len(begins) - 1):
        own = np.concatenate([ids[begins[i]:begins[i + 1]], end])
        for n, at in enumerate(range(0, len(own), capacity)):
            part = own[at:at + capacity]
            rows.append(i)
            number.append(n)
            start.append(at)
            length.append(len(part))
            crc.append(zlib.crc32(part.astype("<u4").tobytes()))
            if with_ids:
                lists.append(part.astype(np.int64))
    columns = [owners.take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns.append(pa.array(lists, pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


# ---------------------------------------------------------------- the genetic algorithm

def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, free: list[int], capacity: int) -> None:
    """Place the items of ``order`` into the bin with the least room that still holds each; new bins at need. Changes both."""
    open_bins = sorted((room, b) for b, room in enumerate(free) if room > 0)
    for item, size in zip(order.tolist(), lengths[order].tolist()):
        at = bisect.bisect_left(open_bins, (size, -1))
        if at == len(open_bins):
            bins[item] = len(free)
            free.append(capacity - size)
            if capacity > size:
                bisect.insort(open_bins, (capacity - size, len(free) - 1))
        else:
            room, b = open_bins.pop(at)
            bins[item] = b
            free[b] = room - size
            if room > size:
                bisect.insort(open_bins, (room - size, b))


def _compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; among equals, the more unevenly filled (sum of squares), which leaves more usable room."""
    load = np.bincount(bins, lengths) / capacity
    return -len(load), float((load * load).sum())


def _refill(lengths, bins, displaced, capacity) -> np.ndarray:
    """Take the displaced items out of their bins and best-fit them again, longest first."""
    bins = bins.copy()
    bins[displaced] = -1
    kept = bins >= 0
    bins[kept] = _compact(bins[kept])
    load = np.bincount(bins[kept], lengths[kept]).astype(np.int64)
    free = (capacity - load).tolist()
    best_fit(lengths, displaced[np.argsort(-lengths[displaced], kind="stable")], bins, free, capacity)
    return bins


def cross(lengths, taker, giver, random, capacity) -> np.ndarray:
    """Whole well-filled bins of ``giver`` go into ``taker``; its bins that share an item with them are emptied."""
    load = np.bincount(giver, lengths)
    full = np.flatnonzero(load >= np.median(load))
    chosen = random.choice(full, size=min(len(full), max(1, len(load) // 12)), replace=False)
    injected = np.isin(giver, chosen)
    hit = np.zeros(taker.max() + 1, bool)
    hit[taker[injected]] = True
    displaced = np.flatnonzero(hit[taker] & ~injected)
    child = taker.copy()
    child[injected] = taker.max() + 1 + giver[injected]
    return _refill(lengths, child, displaced, capacity)


def mutate(lengths, bins, random, capacity) -> np.ndarray:
    """Empty the worst bins and a few others at random."""
    load = np.bincount(bins, lengths)
    worst = np.argsort(load, kind="stable")[:max(1, len(load) // 50)]
    some = random.integers(0, len(load), max(1, len(load) // 50))
    return _refill(lengths, bins, np.flatnonzero(np.isin(bins, np.concatenate([worst, some]))), capacity)


def evolve(lengths: np.ndarray, elites: list[np.ndarray], seed: int, capacity: int = CAPACITY, children: int = CHILDREN) -> np.ndarray:
    """One epoch of one island: the best chromosome after ``children`` births, starting from migrants and best-fit orders."""
    random = np.random.default_rng(seed)
    bound = -(-int(lengths.sum()) // capacity)
    people = list(elites)
    while len(people) < POPULATION:
        bins = np.full(len(lengths), -1, np.int32)
        noise = 0 if not people else 0.05 * len(people)
        order = np.argsort(-lengths * (1 + noise * random.random(len(lengths))), kind="stable")
        best_fit(lengths, order, bins, [], capacity)
        people.append(bins)
    ranked = sorted(((fitness(lengths, p, capacity), i, p) for i, p in enumerate(people)), key=lambda x: x[:2], reverse=True)
    births = len(ranked)
    for _ in range(children):
        if -ranked[0][0][0] <= bound:
            break
        a, b = random.choice(min(len(ranked), POPULATION), 2, replace=False)
        child = cross(lengths, ranked[a][2], ranked[b][2], random, capacity)
        if random.random() < 0.5:
            child = mutate(lengths, child, random, capacity)
        births += 1
        ranked = sorted([*ranked, (fitness(lengths, child, capacity), births, child)], key=lambda x: x[:2], reverse=True)[:POPULATION]
    return ranked[0][2].astype(np.int32)


def pack(items: DataFrame, *, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of at most ``capacity``."""
    names = [n for n in items.columns if n not in ("sequence_id", "offset", "_group")]
    items = written(items.select(*names), "pieces")
    groups = max(1, -(-items.count() // group_items))
    items = items.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    parts = max(1, groups // 2)

    def lengths_of(frame: pd.DataFrame) -> np.ndarray:
        return np.sort(frame["length"].to_numpy(np.int64))[::-1]

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = lengths_of(frame).astype("<i4").tobytes()
        return pd.DataFrame({"_group": frame["_group"].iloc[0], "island": np.arange(ISLANDS, dtype=np.int64), "sizes": sizes, "elite": [b""] * ISLANDS, "migrant": [b""] * ISLANDS})

    def epoch(number: int):
        def step(frames):
            for frame in frames:
                best = []
                for group, island, sizes, *elites in frame[["_group", "island", "sizes", "elite", "migrant"]].itertuples(index=False):
                    start = [np.frombuffer(e, "<i4") for e in elites if e]
                    best.append(evolve(np.frombuffer(sizes, "<i4").astype(np.int64), start, (int(group) * 64 + int(island)) * 64 + number, capacity).astype("<i4").tobytes())
                frame["elite"] = best
                yield frame

        return step

    state_type = "_group long, island long, sizes binary, elite binary, migrant binary"
    state = items.select("_group", "length").groupBy("_group").applyInPandas(found, state_type)
    for number in range(EPOCHS):
        state = state.repartition(parts * ISLANDS, "_group", "island").mapInPandas(epoch(number), state_type)
        state = written(state, "islands")
        ring = state.select("_group", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("migrant"))
        state = state.drop("migrant").join(ring, ["_group", "island"]).select("_group", "island", "sizes", "elite", "migrant")

    def settle(key: tuple, frame: pd.DataFrame, islands: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", *(n for n in ("doc_id", "piece", "start") if n in frame)], ascending=False, kind="stable")
        lengths = frame["length"].to_numpy(np.int64)
        ranked = sorted(((fitness(lengths, b, capacity), -i, b) for i, b in zip(islands["island"], (np.frombuffer(e, "<i4") for e in islands["elite"]))), key=lambda x: x[:2])
        bins = _compact(ranked[-1][2])
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
        offset = np.empty(len(frame), np.int64)
        offset[order] = begins - np.maximum.accumulate(np.where(first, begins, 0))
        return frame.drop(columns="_group").assign(sequence_id=int(key[0]) * (1 << 20) + bins.astype(np.int64), offset=offset)

    from pyspark.sql import types as T

    schema = T.StructType([*(f for f in items.schema.fields if f.name != "_group"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return items.groupBy("_group").cogroup(state.groupBy("_group")).applyInPandas(settle, schema)


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
