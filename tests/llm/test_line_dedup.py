import hashlib

import brute
import pytest

from lendloom.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string, n_lines string, lang string"


def plain(rows, min_docs):
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(brute.LOWER) for line in (t or "").split("\n")] for _, t in rows]
    count = {}
    for own in keys:
        for k in set(own):
            count[k] = count.get(k, 0) + 1
    out = []
    for (key, text), own in zip(rows, keys):
        kept = [line for line, k in zip((text or "").split("\n"), own) if not (k and count[k] >= min_docs)]
        out.append((key, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    shared = ["All rights reserved.", "  all RIGHTS reserved. \t", "ÄÖ Zeile"]
    made = [(i, f"{shared[i % 2]}\nown {i}\n{shared[2] if i < 2 else 'x' * i}\n\nown {i}") for i in range(6)]
    return [*made, (6, None), (7, ""), (8, "long " * 50_000 + "\nown 1"), (1, made[1][1]), (9, "\r\n \n")]


def collected(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_docs", [2, 3, 6])
def test_same_as_plain(spark, rows, min_docs):
    df = spark.createDataFrame([(a, b, "clash", None) for a, b in rows], SCHEMA).repartition(3)
    out = dedup_lines(df, min_docs=min_docs)
    assert out.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped", "kept_sha256"]
    assert collected(out) == plain(rows, min_docs)


def test_many_blocks_and_a_full_filter(spark, rows, monkeypatch):
    """A filter too small for its keys, and repeated keys in several broadcast blocks, change nothing."""
    import lendloom.llm.line_dedup as module

    monkeypatch.setattr(module, "MOST_BITS", 1 << 8)
    monkeypatch.setattr(module, "LEAST_BITS", 1 << 8)
    monkeypatch.setattr(module, "BROADCAST_BYTES", 64)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert collected(dedup_lines(df, min_docs=2)) == plain(rows, 2)


def test_first_document_keeps_its_line(spark):
    df = spark.createDataFrame([(3, "a\nb"), (1, "A \na\nc"), (2, "a")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in dedup_lines(df, min_docs=2, first="doc_id").collect()} == {1: "A \nc", 2: "", 3: "b"}


def test_empty(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
