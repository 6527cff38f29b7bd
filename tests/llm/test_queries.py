"""Queries with SQL against DuckDB; queries without it and the pipeline against plain Python."""

import math

import brute
import duckdb
import oracle
import pytest

import corpus_pipeline
from corpus_pipeline import ORACLES, QUERIES, STAGES, run
from lendloom.llm.common import read

FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES) and len(STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    connection = oracle.connect(FOLDER)
    assert oracle.compare(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == ""


def rows_of(table):
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{table}.parquet'").fetchall()


def test_the_sql_itself():
    """The SQL of the links and of the contamination rule against plain Python."""
    connection = oracle.connect(FOLDER)
    docs = [(r[0], r[1]) for r in rows_of("documents")]
    links = {a: (n, c) for a, n, c in connection.execute(ORACLES["op3_jaccard_join"]).fetchall()}
    assert links == brute.jaccard_components(docs)
    hits = connection.execute(ORACLES["op5_decontamination"]).fetchall()
    assert sorted(hits) == sorted(brute.contamination(docs, rows_of("benchmark")))


def test_pipeline(spark):
    from lendloom.llm.language_id import classify, fit
    from lendloom.llm.packing import pieces, public_tokenizer

    docs = read(spark, FOLDER, "documents")
    told = {r["doc_id"] for r in classify(docs, fit(docs)).where("not rejected").select("doc_id").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in told]
    keys = {i: [line.strip(" \t\n\x0b\x0c\r").translate(brute.LOWER) for line in (t or "").split("\n")] for i, t in rows}
    count = {}
    for own in keys.values():
        for k in set(own):
            count[k] = count.get(k, 0) + 1
    rows = [(i, "\n".join(line for line, k in zip((t or "").split("\n"), keys[i]) if not (k and count[k] >= 10))) for i, t in rows]
    rows = [(i, t) for (i, t), of in zip(rows, _components(rows)) if of == i]
    rows = [(i, t) for (i, t), c in zip(rows, brute.contamination(rows, rows_of("benchmark"))) if not c[5]]
    expected = pieces(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizer("word_bpe_49k.json"))
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    found = run(spark, FOLDER).collect()
    assert sorted(map(key, found)) == sorted(map(key, expected.collect()))
    sequences = {r["sequence_id"] for r in found}
    assert len(sequences) <= math.ceil(sum(r["length"] for r in found) / 2048) + 2


def _components(rows):
    of = brute.jaccard_components(rows)
    return [of[i][1] for i, _ in rows]


def test_stages_keep_the_columns(spark):
    docs = read(spark, FOLDER, "documents").limit(40)
    for _, stage in STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    none = docs.limit(0)
    assert all(stage(spark, none, FOLDER).count() == 0 for _, stage in STAGES)


def test_the_pipeline_packs_with_few_rows_in_python(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(corpus_pipeline, "pack", lambda items, capacity: seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) or items)
    corpus_pipeline.packed(spark, spark.createDataFrame([(1, "a")], "doc_id long, text string"), "")
    assert seen == [str(corpus_pipeline.ROWS_AT_ONCE)]


def test_the_pipeline_keeps_each_stage_once(spark, monkeypatch):
    """A stage that has written its result is not written again, and copies of texts are packed tightly."""
    kept = []
    monkeypatch.setattr(corpus_pipeline, "written", lambda df, name, compression=None: kept.append((name, compression)) or df)
    own = lambda spark, docs, sf_dir: corpus_pipeline.in_small_batches(docs, lambda: docs, "own")
    lazy = lambda spark, docs, sf_dir: docs
    monkeypatch.setattr(corpus_pipeline, "WRITTEN", {own})
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("own", own), ("lazy", lazy), ("last", lazy)])
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert kept == [("own", "zstd"), ("stage-lazy", "zstd")]
    assert {f for _, f in STAGES} >= {corpus_pipeline.known_language, corpus_pipeline.fresh_lines, corpus_pipeline.decontaminated}
