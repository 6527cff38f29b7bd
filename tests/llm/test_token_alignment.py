import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lendloom.llm.packing import public_tokenizer
from lendloom.llm.token_alignment import Aligner, ByteLevel, align, cuts, ending, units

A, B = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model")
TEXTS = [None, "", " ", "Hello, World!! it's 25°C", "<|endoftext|> x </s> <s>", "a  b\t c\n\n d ", "naïve Ωmega 漢字 🎉 é", "the same", "the same", "▁ under", "end ", " nbsp \x00 nul", "word " * 3000 + "x"]


def bytes_of(path):
    """Token bytes by the vocabularies' own decoders."""
    if path == B:
        tool = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [tool.id_to_piece(i) for i in range(tool.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    vocabulary = Tokenizer.from_file(path).get_vocab()
    return {i: bytes(of[c] for c in p) if all(c in of for c in p) else p.encode() for p, i in vocabulary.items()}


def plain(texts):
    """The contract in plain Python: pairs of tokens that end together, counted over all texts."""
    a_tool = Tokenizer.from_file(A)
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=B)
    a_bytes, b_bytes = bytes_of(A), bytes_of(B)
    docs = []
    for text in texts:
        a = a_tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tool.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            docs.append(None)
            continue
        ends_a, ends_b, at = [], [], 0
        for i in a:
            ends_a.append(at := at + len(a_bytes[i]))
        at = 0
        for i in b:
            ends_b.append(at := at + len(b_bytes[i]))
        cuts, groups, low = [e for e in ends_a if e in set(ends_b)], [], 0
        for cut in cuts:
            groups.append((",".join(str(i) for i, e in zip(a, ends_a) if low < e <= cut), ",".join(str(i) for i, e in zip(b, ends_b) if low < e <= cut)))
            low = cut
        where = dict(zip(ends_b, b))
        docs.append((len(a), len(b), groups, [(x, where[e]) for x, e in zip(a, ends_a) if e in where]))
    counts = Counter(link for d in docs if d for link in d[3])
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    for d in docs:
        if d is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        text = ";".join("|".join(g) for g in d[2])
        yield (d[0], d[1], len(d[2]), len(d[3]), sum(counts[k] == most[k[1]] for k in d[3]), sum(counts[k] for k in d[3]), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("block_bytes", [1 << 24, 1])
def test_against_plain_python(spark, block_bytes):
    df = spark.createDataFrame([(k, t, 9) for k, t in enumerate(TEXTS)], "doc_id long, text string, pairs int").repartition(3)
    rows = {r["doc_id"]: tuple(r)[1:] for r in align(df, A, B, block_bytes=block_bytes).collect()}
    assert [rows[k] for k in range(len(TEXTS))] == list(plain(TEXTS))


def test_table_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 60").collect()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = {r["doc_id"]: tuple(r)[1:] for r in align(df, A, B).collect()}
    assert [rows[d["doc_id"]] for d in docs] == list(plain([d["text"] for d in docs]))


def test_units_leave_the_ids_as_they_are():
    random, aligner = np.random.default_rng(6), Aligner(A, B)
    pieces = [" ", "  ", "\n", " \n", "\t", "\xa0", "\x1c", "\x85", "\u3000", "word", "It's", "12", "é", "漢字", "!?", "▁", "don't", "<s>"]
    for _ in range(400):
        text = "".join(random.choice(pieces, 12))
        parts = units(text)
        assert " ".join(parts) == text
        for tool in (aligner.a, aligner.b):
            assert [i for own in tool.encode(parts) for i in own] == tool.encode([text])[0], (text, parts)


def test_the_fast_way_gives_the_ids_of_the_file(spark):
    own = ByteLevel(A)
    assert own.fast is not None
    random = np.random.default_rng(1)
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(400).collect()]
    texts += ["".join(chr(c) for c in random.choice([*range(9, 14), *range(32, 127), 160, 233, 8217, 0x3000, 0x4E2D, 0x1F389, 0x0661], 80)) for _ in range(300)]
    fast = own.encode(texts)
    own.fast = None
    assert own.encode(texts) == fast


def test_forgetting_changes_nothing():
    texts = ["one two three", "two three four five", "", "six one"]
    whole, short = Aligner(A, B), Aligner(A, B, most_units=1)
    for text in texts * 2:
        for x, y in zip(whole.documents([text])[0], short.documents([text])[0]):
            assert np.array_equal(x, y)


def test_groups_as_text(spark):
    rows = align(spark.createDataFrame([("x", "some words")], "doc_id string, text string"), A, B, with_groups=True).collect()
    assert hashlib.sha256(rows[0]["groups"].encode()).hexdigest() == rows[0]["groups_sha256"]


def test_cuts_and_empty_tokens():
    sizes = [0, 1, 2, 3]
    assert cuts([1, 2, 3], [3, 3], sizes, sizes) == ([2, 3], [1, 2])
    assert cuts([1, 0], [1], sizes, sizes) == ([2], [1]) and ending([2, 1, 0, 0], sizes) == [1, 0, 0]


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
