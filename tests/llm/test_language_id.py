from lendloom.llm.language_id import Compressors, classify, fit, held_out, letters

ROWS = [(i, t, lang, "old") for i, (t, lang) in enumerate(
    [(f"the house and the garden of the old man number {'abcdefgh'[k % 8]} is on the hill with these trees", "en") for k in range(30)]
    + [(f"das haus und der garten von dem alten mann {'abcdefgh'[k % 8]} ist auf dem hügel mit diesen bäumen", "de") for k in range(30)])]


def test_predictions_and_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, score string")
    tables = fit(docs)
    assert sorted(tables) == ["de", "en"] and all(tables.values())
    odd = [(1, None), (2, ""), (3, "123 !? 45"), (4, "The garden of these trees and the house"), (5, "der Garten auf dem Hügel und das Haus " * 3000), (4, "the man is on the hill"), (None, "und der mann")]
    got = classify(spark.createDataFrame([(a, b, 7) for a, b in odd], "doc_id long, text string, margin int"), tables).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "en", "de", "en", "de"]
    assert [r["rejected"] for r in got][:5] == [True, True, True, False, False]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_ties_go_to_the_smaller_name_and_are_rejected():
    same = Compressors({"b": b"some words here", "a": b"some words here"})
    assert same.judge("words here", 2, 0.01)[0] == "a" and same.judge("words here", 2, 0.01)[3]


def test_empty_fit(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert fit(docs) == {}
    assert classify(docs, {}).first()["lang_pred"] == "und"
    assert classify(docs.limit(0), {}).count() == 0


def test_letters_and_fold(spark):
    assert letters("Ab1_c!\nD") == "ab c d" and letters(None) == ""
    import zlib

    rows = spark.range(50).select("id", held_out("id", 4, 2).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    from lendloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op1_language_id"](spark, folder).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.96 * len(rows)
