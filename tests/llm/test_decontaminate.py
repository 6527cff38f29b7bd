import brute

from lendloom.llm.decontaminate import contamination, near_matches

ITEMS = [("a", " ".join(f"w{i}" for i in range(20))), ("b", "Short item, here"), ("c", None), ("d", "..."), ("e", "short ITEM here"), (None, "no id at all"), ("f", "the the the the the the the the the the the the the the")]
LONG = " ".join(f"w{i}" for i in range(20))
DOCS = [
    (1, f"start {LONG} end"), (2, LONG.upper().replace(" ", ", ")), (3, "w0 w1 w2"), (4, None), (5, ""), (6, "x " * 3000 + "short item. here!"), (7, "the " * 500),
    (8, "q " * 40 + LONG[:60]), (2, LONG), (9, "short item"), (10, "here short"), (11, "item here short item here"),
]
COLUMNS = "n_words n_hit n_items items_sha256 contaminated".split()


def found(df):
    return sorted([(r["doc_id"], *(r[c] for c in COLUMNS)) for r in df.collect()], key=str)


def test_same_as_plain(spark):
    docs = spark.createDataFrame([(a, b, "clash") for a, b in DOCS], "doc_id long, text string, items string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    expected = sorted(brute.contamination(DOCS, [i for i in ITEMS if i[0]]), key=str)
    assert found(contamination(docs, bench)) == expected


def test_benchmark_in_blocks(spark):
    from pyspark.sql import functions as F

    from lendloom.llm.decontaminate import phrase_hits

    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    one, many = (sorted(phrase_hits(docs, bench, block_bytes=n).select("doc_id", "n_words", "hit_starts", "hit_ends", F.col("items")).collect(), key=str) for n in (1 << 20, 10))
    assert one == many


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    docs = spark.createDataFrame(DOCS[:3], "doc_id long, text string")
    assert [r["n_hit"] for r in contamination(docs, none).collect()] == [0, 0, 0]
    assert contamination(docs.limit(0), none).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta"), (2, "beta alpha"), (3, "alpha x x x x beta"), (4, "alpha"), (5, "beta")], "doc_id long, text string")
    assert {r["id"] for r in near_matches(docs, ["alpha", "BETA"], 3).collect()} == {1, 2}
