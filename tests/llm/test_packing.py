import math
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lendloom.llm.packing import cross, evolve, mutate, pack, pieces, public_tokenizer, word_tokens

PATH = public_tokenizer("word_bpe_49k.json")
TEXTS = [None, "", "Hello, World!! it's 25°C", "Straße ÉCOLE naïve… — ok", "<|endoftext|> x <|ENDOFTEXT|>", "<|endoftext|> HI There,<|endoftext|>Big WORD A<|b", "HI<| Some UPPER Words", "word " * 5000, "a" * 3000, "the same", "the same", "tab\tnew\nline\x1cfs nbsp em", "é İ Σσς ﬁ"]


def test_pieces_are_the_tokens(spark):
    tokenizer = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, piece int").repartition(2)
    rows = pieces(df, PATH, capacity=64, with_ids=True).collect()
    for i, text in enumerate(TEXTS):
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert [x for r in own for x in r["ids"]] == ids
        assert [r["start"] for r in own] == list(range(0, len(ids), 64)) and all(r["length"] == 64 for r in own[:-1])
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)


@pytest.mark.parametrize("group_items", [4096, 50])
def test_packing_is_valid_and_tight(spark, group_items):
    random = np.random.default_rng(2)
    lengths = [*random.integers(1, 700, 300).tolist(), *[100] * 40, 1000, 1000, 1]
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)] + [(0, lengths[0], "x")], "doc_id long, length long, offset string")
    rows = pack(items, capacity=1000, group_items=group_items).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == sorted([*enumerate(lengths), (0, lengths[0])])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1000
    groups = math.ceil(len(rows) / group_items)
    assert len(sequences) <= math.ceil(sum(r["length"] for r in rows) / 1000) + 1 + groups


def test_plain_texts_are_merged_whole():
    words, tokenizer = word_tokens(PATH), Tokenizer.from_file(PATH)
    texts = ["Plain WORDS, ÉCOLE Straße!! 25 (x-y)\tz\x0b\nend", "", "ÀÞß øÿ %%% a1b22 ...", "×", "it's", "ª \x1c", " ", "x<y>z", "antidisestablishment" * 9]
    data = "".join(texts).encode()
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    own = words.plain.ids(np.frombuffer(data, np.uint8), bounds)
    assert [i for i, ids in enumerate(own) if ids is None] == [3, 4, 5, 7]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(ids.tolist() == e for ids, e in zip(own, expected) if ids is not None)
    ids, begins = words.ids(np.frombuffer(data, np.uint8), bounds)
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == expected


def test_operators_keep_every_item():
    random = np.random.default_rng(0)
    lengths = np.sort(random.integers(1, 100, 120))[::-1].astype(np.int64)
    a, b = (evolve(lengths, [], seed, 100, 0) for seed in (1, 2))
    for child in (cross(lengths, a, b, random, 100), mutate(lengths, a, random, 100)):
        assert (child >= 0).all() and np.bincount(child, lengths).max() <= 100


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pack(pieces(none, PATH)).count() == 0
