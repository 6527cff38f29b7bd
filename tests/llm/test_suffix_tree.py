import math
from collections import Counter

import brute
import numpy as np
import pytest

from lendloom.llm.suffix_tree import END_WORD, Level, chances, score

TRAIN = ["the cat sat on the mat", "the cat sat on the hat", "a dog sat on a log"] * 12 + [None, "", "Zebra " * 300]
TEST = ["The cat sat on the unseen", "", None, "mat mat"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, t, False, "x") for i, t in enumerate(TRAIN)] + [(1000 + i, t, True, "x") for i, t in enumerate(TEST)] + [(1000, TEST[0], True, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, held_out boolean, score string").repartition(3)
    return data, [r.asDict() for r in score(df, least_count=3).collect()]


def test_base_is_exact(rows):
    data, got = rows
    seen = Counter(w for _, t, held, _ in data if not held for w in [*brute.words(t), None])
    n, v = sum(seen.values()), len(seen)
    assert len(got) == len(data)
    for r in got:
        text = next(t for i, t, *_ in data if i == r["doc_id"])
        words = [*brute.words(text), None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(seen[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))


def test_contexts_help(rows):
    _, got = rows
    seen = next(r for r in got if r["doc_id"] == 0)
    assert seen["score"] > seen["base_score"] + 3
    held = next(r for r in got if r["doc_id"] == 1000)
    assert held["score"] > held["base_score"]


def test_states_sum_to_one():
    """Over all words and the unseen one, the chances after a retained context add up to one."""
    words = np.array([11, 22, 33], np.uint64)
    base = np.array([0.5, 0.2, 0.2, 0.1])
    root = Level(words, np.array([50, 20, 20]))
    root.chance = base[:3].copy()
    from lendloom.llm.common import mix
    from lendloom.llm.suffix_tree import _STEP, retain

    pairs = np.array([mix(np.array([11], np.uint64) * _STEP + np.uint64(w))[0] for w in (22, 33)], np.uint64)
    lower = Level(pairs, np.array([40, 5]))
    order = {int(k): i for i, k in enumerate(lower.keys)}
    suffix = np.empty(2, np.int64)
    for w, p in zip((1, 2), pairs):
        suffix[order[int(p)]] = w
    retain(root, lower, np.zeros(2, np.int64), suffix, 1.0, 0.75)
    assert not np.isnan(root.spare[0])
    total = 0.0
    for word, b in zip([11, 22, 33, 99], base):
        words = np.array([11, word], np.uint64)
        total += chances(words, root.find(words), np.array([0.5, b]), [root, lower])[1]
    assert total == pytest.approx(1.0)


def test_no_context_crosses_a_text():
    root = Level(np.array([5, int(END_WORD)], np.uint64), np.array([9, 9]))
    root.chance = np.array([0.5, 0.5])
    root.spare = np.array([0.25, 0.25])
    lower = Level(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    words = np.array([5, END_WORD, 7], np.uint64)
    got = chances(words, root.find(words), np.array([0.5, 0.5, 0.1]), [root, lower])
    assert got.tolist() == [0.5, 0.125, 0.1]


def test_empty(spark):
    assert score(spark.createDataFrame([], "doc_id long, text string, held_out boolean")).count() == 0


def test_better_than_base_on_held_out_texts(spark):
    from lendloom.llm.queries import QUERIES

    rows = [r for r in QUERIES["op2_suffix_tree"](spark, "/root/testdata/sf0.001").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_rare_strings_stay_in_a_large_corpus(spark):
    """A string seen 20 times is kept, however many other words there are."""
    from pyspark.sql import functions as F

    filler = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("repeat('x ', 300000)").alias("text"), F.lit(False).alias("held_out"))
    rare = spark.range(100, 121).select(F.col("id").alias("doc_id"), F.lit("red fox jumps high").alias("text"), (F.col("id") == 120).alias("held_out"))
    row = next(r for r in score(filler.unionByName(rare)).collect() if r["doc_id"] == 120)
    assert row["train_tokens"] == 40 * 300_001 + 20 * 5
    assert row["score"] > row["base_score"] + 3


def test_texts_without_words(spark):
    """A block without strings of two words is answered for no longer ones."""
    rows = score(spark.createDataFrame([(1, None, False), (2, " ", True)], "doc_id long, text string, held_out boolean").coalesce(1)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["train_tokens"]) for r in rows) == [(1, 1, 1), (2, 1, 1)]
    assert all(r["score"] == r["base_score"] for r in rows)


def test_answers_are_short(spark):
    """What blocks are told is kept without keys: a word seen once costs them less than two bytes."""
    import os

    from lendloom.llm.common import written
    from lendloom.llm.suffix_tree import grow, text_blocks

    words = 200_000
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(words // 4)), False) for i in range(4)], "doc_id long, text string, held_out boolean")
    told, n, v = grow(written(text_blocks(docs, "doc_id", "text", "held_out"), "blocks"))
    assert (n, v) == (words + 4, words + 1)
    assert sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in told.inputFiles()) < 2 * words
