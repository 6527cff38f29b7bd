"""Align the token ids that two tokenizers give the same text, and rate every link by how often the corpus makes it.

Both tokenizers see a text after one space. The cumulative byte ends of either id list go into a dictionary from end to index;
the ends that both dictionaries hold, sorted, slice the two lists into groups. Inside a slice every token that ends where the
slice ends is linked with every such token of the other side. A link's *count* is how many links of the whole corpus join the
same two ids; a link is *best* if no other partner of its second id has a higher count.

Texts are read once. A task aligns blocks of about ``BLOCK_BYTES`` of text and writes, for each block, one row: the figures of
its documents, the distinct id pairs of the block with their numbers, and the pairs of each document as compressed codes. Only
the distinct pairs of a block are shuffled: summed over blocks they are the counts, which go back to the blocks that asked. So
a frequent pair is one row of a block, however many links it has, and no partition holds more than its blocks. The highest
counts have one row per id of the second vocabulary, which bounds their broadcast.

For the tokenizers a text is cut into units at its spaces: neither tokenizer joins across such a cut, and both put a token's end
there. A task aligns every distinct unit once, as long as it remembers it.

Null and empty texts, and texts whose token bytes do not give back the text, have no tokens: all figures 0 and an empty digest.
Repeated rows and ids are rows of their own. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.llm.common import batches_of, written

BLOCK_BYTES = 16 << 20
ENCODED_CHARS = 1 << 20
MOST_UNITS, JOINED_CHARS = 500_000, 1 << 17
CUT = re.compile(r"(?<=[^\s▁]) ")
#: The letter that byte-level vocabularies show for a byte: itself if printable, else the next one from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


#: How byte-level tokenizers part a text before they merge bytes.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level BPE of the tokenizers library; strings of special tokens inside a text are plain text.

    If every entry of the vocabulary is what its own text encodes to, merging the pair whose union has the lowest id gives the
    same ids as the listed merges: inside a union that nothing else has crossed, the lower merges have left its listed pair. Then the
    faster merging of tiktoken is used with the vocabulary of the file.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True
        letters = dict(zip(map(chr, [*SHOWN, *range(256, 512 - len(SHOWN))]), [*SHOWN, *(b for b in range(256) if b not in SHOWN)]))
        plain = self.tool.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (1 + max(self.tool.get_vocab().values()))
        for piece, number in self.tool.get_vocab().items():
            self.bytes[number] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.fast = self._fast(plain) if self._own_text(plain) else None

    def _own_text(self, vocabulary: dict[str, int]) -> bool:
        tokenize = self.tool.model.tokenize
        merged = sorted(i for p, i in vocabulary.items() if len(p) > 1)
        return merged == list(range(256, len(vocabulary))) and all([t.id for t in tokenize(p)] == [i] for p, i in vocabulary.items())

    def _fast(self, vocabulary: dict[str, int]):
        import tiktoken

        return tiktoken.Encoding("vocabulary", pat_str=WORDS, mergeable_ranks={self.bytes[i]: i for i in vocabulary.values()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.tool.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:-1], 16)]) if self.tool.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.tool.id_to_piece, range(self.tool.get_piece_size())))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tool.encode(texts, num_threads=1)


_LOADED: dict[str, ByteLevel | Pieces] = {}


def tokenizer(path: str) -> ByteLevel | Pieces:
    """One per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = (ByteLevel if path.endswith(".json") else Pieces)(path)
    return _LOADED[path]


def units(text: str) -> list[str]:
    """The text cut at spaces after a character that is neither white space nor the mark for it; the space is left out: every unit gets one in front.

    Neither tokenizer joins across such a cut, so the ids, and the groups, of a text are those of its units end to end.
    """
    out = CUT.split(text)
    if len(out) > 1 and not out[-1]:
        out[-2:] = [out[-2] + " "]
    return out


def cuts(a: list[int], b: list[int], sizes_a: list[int], sizes_b: list[int]) -> tuple[list[int], list[int]]:
    """Where the groups of two id lists over the same bytes end in either list. Of tokens that end together, a dictionary holds the last."""
    ends_a = dict(zip(accumulate(map(sizes_a.__getitem__, a)), range(1, len(a) + 1)))
    ends_b = dict(zip(accumulate(map(sizes_b.__getitem__, b)), range(1, len(b) + 1)))
    common = sorted(ends_a.keys() & ends_b.keys())
    return list(map(ends_a.__getitem__, common)), list(map(ends_b.__getitem__, common))


def ending(ids: list[int], sizes: list[int]) -> list[int]:
    """The tokens of a slice that end where it ends: the last one, and any before it that only empty tokens follow."""
    at = len(ids) - 1
    while at > 0 and sizes[ids[at]] == 0:
        at -= 1
    return ids[at:]


class Aligner:
    """Aligned units, remembered, since texts repeat their words; a text is put together from its units."""

    def __init__(self, path_a: str, path_b: str, most_units: int = MOST_UNITS):
        self.a, self.b = tokenizer(path_a), tokenizer(path_b)
        self.sizes_a, self.sizes_b = ([len(x) for x in t.bytes] for t in (self.a, self.b))
        self.names_a, self.names_b = (list(map(str, range(len(t.bytes)))) for t in (self.a, self.b))
        self.width, self.most_units = len(self.b.bytes), most_units
        self.lengths_a, self.gapless = np.array(self.sizes_a), 0 not in self.sizes_a and 0 not in self.sizes_b
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.shown: list[str] = []
        #: n_a (-1 if the bytes do not give back the unit), n_b, n_groups, and where the links of the unit begin and how many they are.
        self.figures, self.links = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Align new units, many at once as one text: what holds for the units of a text holds for any units in a row."""
        joined, size = [[]], 0
        for unit in new:
            if not unit or unit[-1].isspace() or unit[-1] == "▁":
                joined.insert(0, [unit])  # nothing may follow it
                continue
            if size > JOINED_CHARS:
                joined.append([])
                size = 0
            joined[-1].append(unit)
            size += len(unit)
        joined = [own for own in joined if own]
        while joined:
            texts = [" ".join(own) for own in joined]
            again = []
            for own, text, a, b in zip(joined, texts, self.a.encode(texts), self.b.encode(texts)):
                whole = (" " + text).encode()
                if b"".join(map(self.a.bytes.__getitem__, a)) == whole == b"".join(map(self.b.bytes.__getitem__, b)):
                    self._add(own, a, b)
                elif len(own) > 1:  # one of them does not come back: each on its own
                    again += [[unit] for unit in own]
                else:
                    self._keep(own, [""], np.array([[-1, 0, 0, len(self.links), 0]]), np.zeros(0, np.int64))
            joined = again

    def _add(self, own: list[str], a: list[int], b: list[int]) -> None:
        names_a, names_b, sizes_a, sizes_b = self.names_a, self.names_b, self.sizes_a, self.sizes_b
        to_a, to_b = cuts(a, b, sizes_a, sizes_b)
        shown = [
            names_a[a[i]] + "|" + names_b[b[j]] if to_i - i == 1 == to_j - j
            else ",".join(map(names_a.__getitem__, a[i:to_i])) + "|" + ",".join(map(names_b.__getitem__, b[j:to_j]))
            for i, to_i, j, to_j in zip([0, *to_a], to_a, [0, *to_b], to_b)
        ]
        ids_a, ids_b = np.array(a), np.array(b)
        upto_a, upto_b = np.array([0, *to_a]), np.array([0, *to_b])
        if self.gapless:
            links, upto_links = ids_a[upto_a[1:] - 1] * self.width + ids_b[upto_b[1:] - 1], np.arange(len(upto_a))
        else:  # empty tokens end where the one before them does
            pairs = [
                [p * self.width + q for p, q in product(ending(a[i:to_i], sizes_a), ending(b[j:to_j], sizes_b))]
                for i, to_i, j, to_j in zip([0, *to_a], to_a, [0, *to_b], to_b)
            ]
            links, upto_links = np.array([x for own_ in pairs for x in own_], np.int64), np.concatenate([[0], np.cumsum([len(x) for x in pairs])])
        # The groups of a unit are those up to its last byte, where both sides have an end.
        ends = np.cumsum(self.lengths_a[ids_a])[upto_a[1:] - 1]
        lasts = np.searchsorted(ends, np.cumsum([1 + len(unit.encode()) for unit in own]), "right")
        firsts = np.concatenate([[0], lasts[:-1]])
        begins = upto_links[firsts]
        figures = np.stack([upto_a[lasts] - upto_a[firsts], upto_b[lasts] - upto_b[firsts], lasts - firsts, begins + len(self.links), upto_links[lasts] - begins], 1)
        self._keep(own, [";".join(shown[i:j]) for i, j in zip(firsts.tolist(), lasts.tolist())], figures, links)

    def _keep(self, own: list[str], shown: list[str], figures: np.ndarray, links: np.ndarray) -> None:
        self.known.update(zip(own, range(len(self.shown), len(self.shown) + len(own))))
        self.shown += shown
        self.figures, self.links = np.concatenate([self.figures, figures]), np.concatenate([self.links, links])

    def documents(self, texts: list[str], with_groups: bool = False) -> list[tuple]:
        """For each text: n_a, n_b, n_groups, the digest of its groups, its links as numbers ``a * width + b``, and the groups."""
        if len(self.known) > self.most_units:
            self._forget()
        split = [units(t) if t else [] for t in texts]
        new = list({u for own in split for u in own} - self.known.keys())
        if new:
            self._learn(new)
        out = []
        for own in split:
            at = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
            figures = self.figures[at]
            if not len(at) or figures[:, 0].min() < 0:
                out.append((0, 0, 0, "", np.zeros(0, np.int64), ""))
                continue
            groups = ";".join(map(self.shown.__getitem__, at.tolist()))
            sizes = figures[:, 4]
            ends = np.cumsum(sizes)
            links = self.links[np.repeat(figures[:, 3] - (ends - sizes), sizes) + np.arange(ends[-1])]
            out.append((*figures[:, :3].sum(0).tolist(), hashlib.sha256(groups.encode()).hexdigest(), links, groups if with_groups else ""))
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One per worker process and pair of files, so that units are remembered from task to task; their number is bounded."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)


def _block(number: int, ids: list, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """One row for a block. A pair's code is its rank by frequency in the block, so that a document's sorted codes lie close."""
    owner = np.repeat(np.arange(len(rows)), [len(r[4]) for r in rows])
    pairs, place, counts = np.unique(np.concatenate([np.asarray(r[4], np.int64) for r in rows]), return_inverse=True, return_counts=True)
    rank = np.argsort(-counts, kind="stable")
    code = np.empty(len(rank), np.int64)
    code[rank] = np.arange(len(rank))
    width = max(1, len(pairs))
    each, times = np.unique(owner * width + code[place], return_counts=True)
    doc = each // width
    step = np.diff(each % width, prepend=0)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    step[first] = each[first] % width
    sizes = np.bincount(doc, minlength=len(rows))
    columns = {
        "block": pa.array([number], pa.int64()), "ids": pa.array([ids], pa.list_(kind)),
        **{name: pa.array([[r[k] for r in rows]], pa.list_(pa.int64())) for k, name in enumerate(("n_a", "n_b", "n_groups"))},
        "n_links": pa.array([[len(r[4]) for r in rows]], pa.list_(pa.int64())),
        "digests": pa.array([[r[3] for r in rows]], pa.list_(pa.string())), "groups": pa.array([[r[5] for r in rows]], pa.list_(pa.string())),
        "codes": pa.array([b"".join(len(x).to_bytes(4, "little") + x for x in map(_packed, (sizes, step, times)))], pa.binary()),
        "pairs": pa.array([pairs[rank]], pa.list_(pa.int64())), "times": pa.array([counts[rank]], pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_pydict(columns)


def _codes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document of every distinct pair, its code, and how many links of the document make it."""
    parts, at = [], 0
    for _ in range(3):
        size = int.from_bytes(data[at:at + 4], "little")
        parts.append(_unpacked(data[at + 4:at + 4 + size]))
        at += 4 + size
    sizes, step, times = parts
    doc = np.repeat(np.arange(len(sizes)), sizes)
    total = np.cumsum(step)
    begins = np.cumsum(sizes) - sizes
    before = np.where(begins > 0, total[np.minimum(begins, len(total)) - 1] if len(total) else 0, 0)
    return doc, total - before[doc], times


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, path_a: str, path_b: str, *, id_column: str = "doc_id", column: str = "text", block_bytes: int = BLOCK_BYTES, with_groups: bool = False) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if wanted, ``groups`` as text."""
    spark = docs.sparkSession
    docs = docs.select(id_column, column)
    id_type = docs.schema[id_column].dataType

    def blocks(batches):
        aligner, made, ids, rows, size = aligner_of(path_a, path_b), 0, [], [], 0
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            kind, keys, texts = batch.schema.field(id_column).type, batch.column(id_column).to_pylist(), batch.column(column)
            low = 0
            while low < batch.num_rows:
                some, held = [], 0
                while low + len(some) < batch.num_rows and held < ENCODED_CHARS:
                    some.append(texts[low + len(some)].as_py() or "")
                    held += len(some[-1])
                rows += aligner.documents(some, with_groups)
                ids += keys[low:low + len(some)]
                low, size = low + len(some), size + held
                if size >= block_bytes:
                    yield _block(task + made, ids, rows, kind)
                    made, ids, rows, size = made + 1, [], [], 0
        if rows:
            yield _block(task + made, ids, rows, kind)

    lists = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), *(T.StructField(n, lists) for n in FIGURES),
        T.StructField("digests", T.ArrayType(T.StringType())), T.StructField("groups", T.ArrayType(T.StringType())),
        T.StructField("codes", T.BinaryType()), T.StructField("pairs", lists), T.StructField("times", lists),
    ])
    held = written(docs.mapInArrow(blocks, schema), "aligned")
    width = len(tokenizer(path_b).bytes)
    used = held.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("code", "p")).select("block", "code", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    counts = written(used.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    # One row per id of the second vocabulary.
    highest = F.broadcast(counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most")))
    rated = counts.withColumn("b", F.col("pair") % width).join(highest, "b").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("rate"))
    asked = used.select("block", "code", "pair").join(rated, "pair").groupBy("block").agg(F.collect_list(F.struct("code", "rate")).alias("rates"))
    out = held.drop("pairs", "times").join(asked, "block", "left")

    def rate(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                doc, code, times = _codes(batch.column("codes")[k].as_py())
                ids = batch.column("ids")[k].values
                best, total = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
                if len(doc):
                    of = batch.column("rates")[k].values
                    rates = np.empty(len(of), np.int64)
                    rates[of.field("code").to_numpy()] = of.field("rate").to_numpy()
                    np.add.at(best, doc, times * (rates[code] & 1))
                    np.add.at(total, doc, times * (rates[code] >> 1))
                figures = [batch.column(n)[k].values for n in FIGURES]
                text = [batch.column("digests")[k].values, *([batch.column("groups")[k].values] if with_groups else [])]
                yield pa.RecordBatch.from_arrays([ids, *figures, pa.array(best), pa.array(total), *text], names=result.names)

    result = T.StructType([
        T.StructField(id_column, id_type), *(T.StructField(n, T.LongType()) for n in (*FIGURES, "n_best", "count_sum")),
        T.StructField("groups_sha256", T.StringType()), *([T.StructField("groups", T.StringType())] if with_groups else []),
    ])
    with batches_of(spark, 2):
        return written(out.mapInArrow(rate, result), "token-links")

