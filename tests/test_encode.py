"""Fills, rare labels, rates, column selection, files."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendloom.operators import encode, profile
from lendloom.params import BINARY_LABELS
from lendloom.plans import training
from lendloom.sources import files

MISSING_SCHEMA = "k int, often string, seldom string, num double"


def state(df):
    return {r["feature"]: (r["kind"], r["value"]) for r in df.collect()}


def closed_tail(statistic, dof):
    """The chi-square tail by its finite sums for whole degrees of freedom."""
    if dof < 1 or statistic <= 0:
        return 1.0
    half = statistic / 2
    tail, power, terms = (math.erfc(math.sqrt(half)), 0.5, (dof - 1) // 2) if dof % 2 else (math.exp(-half), 1.0, dof // 2 - 1)
    for _ in range(terms):
        tail += math.exp(power * math.log(half) - half - math.lgamma(power + 1))
        power += 1
    return min(tail, 1.0)


def test_heavy_labels_against_all_counts(spark):
    random = np.random.default_rng(8)
    data = {"a": random.zipf(1.3, 5000), "b": random.integers(0, 30, 5000), "id": np.arange(5000), "text": [("x" * 300 + str(k)) if k % 4 else "same" for k in range(5000)], "none": [None] * 5000}
    rows = [(int(a), int(b) if b < 25 else None, int(i), t, None, int(i) % 3 == 0) for a, b, i, t, _ in zip(*data.values())]
    df = spark.createDataFrame(rows, "a long, b long, id long, text string, none string, bad boolean").withColumn("bad", F.col("bad").cast("int")).repartition(6)
    columns = ["a", "b", "id", "text", "none"]
    for share in (0.9, 0.25, 0.03, 0.01):
        found = {(r["feature"], r["label"]): (r["n"], r["bad"], r["rows"], r["all_bad"]) for r in profile.heavy_labels(df, columns, share, "bad").collect()}
        expected = {}
        for place, name in enumerate(columns):
            for label in {r[place] for r in rows} - {None}:
                own = [r for r in rows if r[place] == label]
                if len(own) >= share * 5000:
                    expected[name, str(label)] = (len(own), sum(r[5] for r in own), 5000, sum(r[5] for r in rows))
        assert found == expected
    assert profile.heavy_labels(df.limit(0), columns, 0.5).count() == 0


def test_states_from_counts_are_those_from_rows(spark):
    random = np.random.default_rng(9)
    rows = [(random.choice(["a", "b", "c", None], p=[0.5, 0.3, 0.005, 0.195]), f"k{int(random.zipf(1.4)) % 300}", float(random.integers(0, 4)) if random.random() < 0.97 else float("nan"), "yes" if random.random() < 0.9 else "no", int(random.random() < 0.3)) for _ in range(3000)]
    df = spark.createDataFrame([(x if x is None else str(x), *r) for x, *r in rows], "few string, many string, number double, two string, bad int").repartition(4)
    columns = ["few", "many", "number", "two"]
    state = training.fit_states(df, columns, [], "bad")
    filled = encode.apply_missing(df, state.missing)
    assert {tuple(r) for r in encode.fit_rare(filled, columns).collect()} == {tuple(r) for r in state.rare.collect()}
    merged = encode.apply_rare(filled, state.rare)
    assert encode.scarce_binary(merged, columns) == state.dropped == ["two"]
    mine = {(r["feature"], r["label"]): r["rate"] for r in encode.fit_target(merged, ["few", "many", "number"], "bad").collect()}
    assert {(r["feature"], r["label"]): r["rate"] for r in state.target.collect()} == pytest.approx(mine)


def test_missing_fit_at_the_five_percent_line(spark):
    rows = [(i, None if i < 6 else "x", None if i < 5 else ("b" if i % 2 else "a"), float("nan") if i < 2 else None if i < 4 else float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, MISSING_SCHEMA)
    fitted = encode.fit_missing(df, ["often", "seldom"], ["num"])
    # 95 values: 'b' has 48, 'a' 47
    assert state(fitted) == {"often": ("text", "Missing"), "seldom": ("text", "b"), "num": ("number", "51.5")}
    filled = encode.apply_missing(df, fitted)
    assert filled.where("often IS NULL OR seldom IS NULL OR num IS NULL OR isnan(num)").count() == 0
    assert filled.where("num = 51.5").count() == 4 and filled.where("often = 'Missing'").count() == 6


def test_mode_tie_takes_the_smallest_label(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    assert profile.mode_labels(df, ["v"]).first()["mode"] == "a"


def test_rare_labels(spark):
    wide = ["a"] * 480 + ["b"] * 480 + ["at_line"] * 10 + [f"r{i}" for i in range(30)]
    few = ["x"] * 900 + ["y"] * 95 + ["z"] * 5
    df = spark.createDataFrame(list(zip(wide, few, [None] * 4 + ["q"] * 996)), "wide string, few string, two string")
    fitted = encode.fit_rare(df, ["wide", "few", "two"])
    found = {(r["feature"], r["label"], r["replacement"]) for r in fitted.collect() if r["label"] is not None}
    # exactly one percent is not frequent; 'rare' itself is, with 4 % of the rows; three values go to their mode
    assert found == {("wide", "a", "rare"), ("wide", "b", "rare"), ("wide", "rare", "rare"), ("few", "x", "x"), ("few", "y", "x"), ("two", "q", "rare")}
    new = spark.createDataFrame([("a", "y", "q"), ("new", "new", "new"), (None, None, None)], df.schema)
    assert [tuple(r) for r in encode.apply_rare(new, fitted).collect()] == [("a", "y", "q"), ("rare", "x", "rare"), ("rare", "x", "rare")]


def test_scarce_binary(spark):
    df = spark.createDataFrame([("a" if i < 19 else "b", "a" if i < 20 else "b", "a" if i < 5 else "b" if i < 50 else "c") for i in range(100)], "u string, v string, w string")
    assert encode.scarce_binary(df, ["u", "v", "w"]) == ["u"]


def test_target_rates_in_range_and_unseen(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1)], "v string, y int")
    fitted = encode.fit_target(train, ["v"], "y")
    assert {(r["label"], r["rate"]) for r in fitted.collect()} == {("a", 0.5), ("b", 0.0)}
    new = spark.createDataFrame([("a",), ("c",), (None,)], "v string")
    assert [r[0] for r in encode.apply_target(new, fitted).collect()] == [0.5, None, None]
    assert [r[0] for r in encode.apply_target(new, fitted, 0.3).collect()] == [0.5, 0.3, 0.3]


def test_large_state(spark):
    train = spark.range(3000).select(F.col("id").cast("string").alias("v"), (F.col("id") % 2).cast("int").alias("y"))
    fitted = encode.fit_target(train, ["v"], "y")
    assert encode.apply_target(train, fitted).where("v <> y OR v IS NULL").count() == 0


def test_labels_of_another_number_type(spark):
    """States fitted on INT hold for the same values as DOUBLE, text labels are untouched."""
    train = spark.createDataFrame([(i % 3, str(i % 3), i % 2) for i in range(90)], "n int, t string, y int")
    rare, rates = encode.fit_rare(train.withColumn("n", F.col("n") * 10), ["n"], 0.0), encode.fit_target(train, ["n", "t"], "y")
    wide = train.select(F.col("n").cast("double"), "t", "y")
    assert encode.apply_rare(wide.withColumn("n", F.col("n") * 10), rare).where("n IN ('0.0', '10.0', '20.0')").count() == 90
    assert encode.apply_target(wide, rates).collect() == encode.apply_target(train, rates).collect()
    assert encode.apply_target(wide, rates).where("n IS NULL OR t IS NULL").count() == 0


def test_states_come_from_train_rows_only(spark):
    rows = spark.createDataFrame([("a" if i % 3 else "b", float(i), i % 2) for i in range(100)], "v string, n double, y int")
    test = spark.createDataFrame([("zzz", 1e9, 1), (None, None, 0)], rows.schema)
    fitted = training.fit_states(rows, ["v"], ["n"], "y")
    assert training.transform(test, fitted, 0.25).select("v", "n").collect() == [(0.25, 1e9), (pytest.approx(0.5, abs=0.1), 49.5)]


def test_binary_map_touches_named_columns_only(spark):
    df = spark.createDataFrame([("Y", "Y"), ("N", "N"), ("3", "3"), (None, None)], "a string, b string")
    assert [tuple(r) for r in encode.encode_binary(df, ["a"], BINARY_LABELS).collect()] == [(0.0, "Y"), (1.0, "N"), (3.0, "3"), (None, None)]


def test_split_is_stable(spark):
    df = spark.range(1000)
    train, test = encode.split(df, "id")
    again, _ = encode.split(df.repartition(7), "id")
    assert train.count() + test.count() == 1000 and 240 < test.count() < 360
    assert sorted(train.collect()) == sorted(again.collect())


def test_column_roles(spark):
    rows = [(1, None if i % 2 else 5, "same", None if i < 45 else "x", float(i), i % 3, i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "one int, one_or_null int, text string, sparse string, num double, few int, y int")
    assert profile.droppable_columns(df) == ["one", "one_or_null", "text", "sparse"]
    assert profile.split_columns(df, "y") == (["one_or_null", "sparse", "few"], ["num"], ["one", "text"])
    assert profile.near_constant_columns(df, ["one", "few", "num"]) == ["one"]


def test_chi_square_tail(spark):
    assert closed_tail(3.841458820694124, 1) == pytest.approx(0.05) and closed_tail(11.070497693516351, 5) == pytest.approx(0.05)
    cases = [(0.0, 3), (2000.0, 4), (5.0, 0), *((s, d) for d in (1, 2, 3, 4, 7, 10, 51, 200, 999, 5000) for s in (0.01, 0.5, 0.3 * d, 0.9 * d, 1.0 * d, 1.1 * d, 1.5 * d, 4.0 * d + 3))]
    df = spark.createDataFrame(cases, "statistic double, dof long")
    for row in df.withColumn("p", profile.chi_square_tail(F.col("statistic"), F.col("dof"))).collect():
        assert row["p"] == pytest.approx(closed_tail(row["statistic"], row["dof"]), rel=1e-8, abs=1e-12), row


def test_chi_square_without_correction_matches_spark_ml(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = spark.createDataFrame([(f"l{i * i % 5}", int(i * 7 % 11 < 4)) for i in range(300)], "v string, y int")
    indexed = VectorAssembler(inputCols=["vi"], outputCol="f").transform(StringIndexer(inputCol="v", outputCol="vi").fit(df).transform(df))
    expected = ChiSquareTest.test(indexed, "f", "y", True).first()
    mine = profile.chi_square(df, ["v"], "y").first()
    assert (mine["statistic"], mine["dof"]) == (pytest.approx(expected["statistic"]), expected["degreesOfFreedom"])
    assert closed_tail(mine["statistic"], mine["dof"]) == pytest.approx(expected["pValue"])


def test_minority_rate(spark):
    rows = [("top" if i >= 10 else ("r" if i < 8 else None), "top" if i >= 5 else "r", int(i < 4 or i % 10 == 9)) for i in range(100)]
    found = {r["feature"]: r["log_ratio"] for r in profile.minority_bad_rate(spark.createDataFrame(rows, "a string, b string, y int"), ["a", "b"], "y").collect()}
    assert found["a"] == pytest.approx(math.log((5 / 10) / (9 / 90))) and found["b"] == pytest.approx(math.log((4 / 5) / (10 / 95)))


def test_join_renames_names_on_both_sides(spark):
    left = spark.createDataFrame([(1, "l")], "id int, state string")
    right = spark.createDataFrame([(1, "r", 5)], "key int, state string, other int")
    joined = training.join_renamed(left, right, "id", "key")
    assert joined.columns == ["id", "state_x", "key", "state_y", "other"] and joined.first() == (1, "l", 1, "r", 5)


def test_clean(spark):
    df = spark.createDataFrame([("jp chase", "a@b", "12%x", "93%", "1/1/2021", "1/3/2021 12:00:00 PM")], "bank string, mail string, emp string, pct string, seen string, tx string")
    rules = training.CleanRules(bank=["bank"], upper=["mail"], prefix=["emp"], percent=["pct"], number={"emp": 100}, dates=["seen"], transaction="tx", drop=["tx"])
    assert training.clean(df, rules).first().asDict() == {"bank": "CHASE", "mail": "A@B", "emp": 0.12, "pct": 0.93, "seendiff": 2.5}


def test_customer_features(spark):
    df = spark.createDataFrame([("p1", None, 5, 10), ("p2", "Old", 5, 0)], "sub_id string, pre_status string, total_paid int, total_lent int")
    rows = training.customer_features(df, ["p1"], "main").collect()
    assert [(r["sub_id"], r["pre_status"], r["static_pool"]) for r in rows] == [("main", "BrandNew", 0.5), ("p2", "Old", None)]


def test_request_text_round_trip(spark):
    when = dt.datetime(2021, 3, 4, 15, 6, 7)
    df = spark.createDataFrame([(1, 'say "hi"\\', float("nan"), when), (2, None, 0.5, None)], "id int, name string, share double, at timestamp")
    texts = [r["json"] for r in files.request_json(df, ["id", "name", "share", "at"]).collect()]
    assert texts[1] == '{"id":[2],"name":[null],"share":[0.5],"at":[null]}'
    assert '"at":["03/04/2021, 15:06:07PM"]' in texts[0] and '"share":[null]' in texts[0]
    back = files.request_rows(spark.createDataFrame([(t,) for t in texts], "json string"), "json", {"id": "int", "name": "string", "share": "double"})
    assert [tuple(r) for r in back.collect()] == [(1, 'say "hi"\\', None), (2, None, 0.5)]


def test_request_with_several_rows(spark):
    df = spark.createDataFrame([('{"a":[1,2],"b":["x"]}',)], "json string")
    assert [tuple(r) for r in files.request_rows(df, "json", {"a": "int", "b": "string"}).collect()] == [(1, "x"), (2, None)]


def test_csv_append_keeps_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    for value in ('a,"b"', "line\nbreak"):
        files.write_csv(spark.createDataFrame([(1, value)], "id int, v string"), path, mode="append")
    assert sorted(r["v"] for r in files.read_csv(spark, path, "id int, v string").collect()) == ['a,"b"', "line\nbreak"]
