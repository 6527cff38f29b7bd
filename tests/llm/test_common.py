import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from lendloom.llm.common import ALNUM, components, shingle_hashes, slices, utf8, word_hashes


def links_of(kind):
    random.seed(4)
    if kind == "chain":
        nodes = random.sample(range(1000), 60)
        return list(zip(nodes, nodes[1:]))
    if kind == "star":  # one node owns all links
        return [(7, n) for n in range(100, 400)] + [(n, 7) for n in range(500, 520)]
    return [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(5, 5)]


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    links = links_of(kind)
    frame = spark.createDataFrame(links, "a long, b long").repartition(4)
    found = {r["node"]: r["component"] for r in components(frame).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == brute.components(nodes, [(a, b) for a, b in links if a != b])


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


TEXTS = ["One two  three", None, "", "  x", "ÄÖ über\tx\n", "one TWO three", "a" * 100_000 + " b", "\x0b\x1c y"]


@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_words_of_texts(most):
    """Equal words have equal hashes and only those; runs of rows cover all rows."""
    of = {}
    rows = 0
    for low, high, data, bounds in slices(pa.array(TEXTS), most):
        hashes, begins = word_hashes(data, bounds)
        for i in range(high - low):
            words = brute.words(TEXTS[low + i])
            assert begins[i + 1] - begins[i] == len(words)
            for w, h in zip(words, hashes[begins[i]:begins[i + 1]].tolist()):
                assert of.setdefault(w, h) == h
        rows += high - low
    assert rows == len(TEXTS) and len(set(of.values())) == len(of)


def test_other_words_and_slices():
    data, bounds = utf8(pa.array(["skip", "It's 2x—ok", None]).slice(1))
    hashes, begins = word_hashes(data, bounds, ALNUM)
    assert begins.tolist() == [0, len(brute.words("It's 2x—ok", brute.ALNUM)), len(brute.words("It's 2x—ok", brute.ALNUM))]


def test_shingles():
    data, bounds = utf8(pa.array(["a b c d e f", "b c d e f", "a b", "A  b", "", "a b c d e f a b c d e f"]))
    sets = shingle_hashes(*word_hashes(data, bounds), 5)
    assert [len(s) for s in sets] == [2, 1, 1, 1, 0, 6]
    assert sets[1][0] in sets[0] and sets[2][0] == sets[3][0]


def test_step_gives_memory_back(monkeypatch):
    from lendloom.llm import common

    calls = []
    monkeypatch.setattr(common, "_trim", lambda: calls.append)
    assert list(common.freed(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3]
    assert calls == [0]


def test_numbers_as_planes():
    """Numbers come back as they were, and planes of sorted ones leave little to a compression."""
    import zlib

    from lendloom.llm.common import of_planes, planes

    ids = np.arange(70_000, 90_000, 7)
    for numbers in (ids, ids.astype(np.uint64) << np.uint64(40), np.linspace(-1, 1, 9), np.zeros(0, np.int32)):
        assert np.array_equal(of_planes([planes(numbers[:3]), planes(numbers[3:])], numbers.dtype), numbers)
    assert np.array_equal(of_planes([planes(np.arange(12.0).reshape(6, 2)[:, 1:])], float), np.arange(1.0, 12, 2))
    assert of_planes([], np.int64).dtype == np.int64
    assert len(zlib.compress(planes(ids), 1)) < 2 * len(ids)


def test_written_takes_a_compression(spark):
    import pyarrow.parquet as pq

    from lendloom.llm.common import written

    kept = written(spark.createDataFrame([(1, "a")], "doc_id long, text string").coalesce(1), "copy", "zstd")
    file = pq.ParquetFile(kept.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert file.metadata.row_group(0).column(1).compression == "ZSTD" and kept.count() == 1
