"""Hot keys: the split paths give the same rows as brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendloom.operators import evaluate, history, ledger, lookups, selection, skew
from lendloom.operators.running import ranges, running

random.seed(7)
# one key holds a third of all rows
ROWS = [(i, "hot" if i % 3 == 0 else f"k{random.randrange(40)}", random.randrange(1000), random.choice("abc")) for i in range(3000)]
SPECS = {"n": ("count", None), "total": ("sum", "value"), "low": ("min", "value"), "high": ("max", "value"), "before": ("previous", "tag")}


def brute_force():
    state, found = {}, {}
    for i, key, value, tag in sorted(ROWS):
        n, total, low, high, before = state.get(key, (0, 0, None, None, None))
        now = (n + 1, total + value, value if low is None else min(low, value), value if high is None else max(high, value))
        found[i] = (*now, before)
        state[key] = (*now, tag)
    return found


@pytest.mark.parametrize("limits", [{}, {"rows_per_task": 400}, {"rows_per_task": 50}])
def test_running_equals_brute_force(spark, limits):
    df = spark.createDataFrame(ROWS, "id long, key string, value long, tag string").repartition(5)
    rows = running(df, ["key"], "id", SPECS, bound=df, **limits).collect()
    assert {r["id"]: (r["n"], r["total"], r["low"], r["high"], r["before"]) for r in rows} == brute_force()


def test_running_with_nulls_in_values(spark):
    data = [(i, "k", None if i % 4 else i) for i in range(40)]
    df = spark.createDataFrame(data, "id long, key string, value long")
    specs = {"total": ("sum", "value"), "before": ("previous", "value")}
    plain = sorted(running(df, ["key"], "id", specs, bound=df).collect())
    assert sorted(running(df, ["key"], "id", specs, bound=df, rows_per_task=8).collect()) == plain


@pytest.mark.parametrize("rows", [
    [(i, "hot") for i in range(4000)],  # a person with consecutive ids
    [(10_000 * f + i, f"feature{f}") for f in range(10) for i in range(400)],  # ten features on ten ranges
])
def test_no_task_holds_more_than_its_share(spark, rows):
    df = spark.createDataFrame(rows, "id long, key string")
    sizes = [r["count"] for r in ranges(df, ["key"], "id", df, 200).groupBy("_range").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 2 * 200 and len(sizes) >= 15


def test_small_ranges_add_no_tasks(spark):
    df = spark.createDataFrame([(i, "hot") for i in range(4000)], "id long, key string")
    dealt = ranges(df, ["key"], "id", df, 10)
    assert dealt.rdd.getNumPartitions() == 4 and dealt.select("_range").distinct().count() >= 400
    spans = dealt.groupBy("_range").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).orderBy("_range").collect()
    assert all(s["n"] <= 10 and s["high"] - s["low"] == s["n"] - 1 for s in spans)
    assert all(a["high"] < b["low"] for a, b in zip(spans, spans[1:]))


def test_unreverted_rows_are_dealt_by_their_number(spark):
    entries = spark.createDataFrame([(i, i - 1 if i % 5 == 0 and i else None) for i in range(1000)], "id long, reference_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = ledger.unreverted(entries, rows_per_task=100)
        assert left.rdd.getNumPartitions() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["id"] for r in left.select("id").collect()) == sorted(set(range(1000)) - {i - 1 for i in range(5, 1000, 5)})


def test_leads_without_an_own_application_do_not_meet_in_one_task(spark):
    leads = spark.createDataFrame([(i, i if i % 50 == 0 else None, "2024-01-02 00:00:00") for i in range(2000)], "lead_id long, failure_applicant_id long, lead_ts string")
    people = spark.createDataFrame([(i, "s", "T", "2024-01-01") for i in range(0, 2000, 100)], "id long, social string, type string, dte string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = history.own_prior_application(leads, people)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        statuses = {r["lead_id"]: r["last_applicant_status"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 1000
    assert statuses == {i: "T" if i % 100 == 0 else "" for i in range(2000)}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_enrich_with_hot_keys(spark, how):
    facts = spark.createDataFrame(ROWS + [(9001, None, 1, "z")], "id long, key string, value long, tag string")
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4)], "key string, extra int")
    assert {r["key"]: r["_salts"] for r in skew.hot_keys(facts, "key", 300).collect()} == {"hot": 4}
    plain = facts.join(lookup, "key", how)
    for limits in ({"rows_per_task": 300}, {}):
        salted = skew.enrich(facts, lookup, "key", how, **limits)
        assert sorted(salted.select(*plain.columns).collect(), key=str) == sorted(plain.collect(), key=str)


def test_enrich_with_hot_keys_on_both_sides(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else "a") for i in range(60)], "l int, key string")
    right = spark.createDataFrame([(i, "hot" if i % 3 else "a") for i in range(40)], "r int, key string")
    hot, other = skew.hot_keys(left, "key", 10), skew.hot_keys(right, "key", 10)
    salted = skew.enrich(left, right, "key", "inner", hot=hot, lookup_hot=other)
    assert sorted(salted.select("l", "r").collect()) == sorted(left.join(right, "key").select("l", "r").collect())


def test_rows_without_key_do_not_pile_up(spark):
    """Nine of ten rows have no key: they are dealt over all partitions of the join."""
    facts = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("key"))
    numbered = skew.dealt(facts, "key", None, "_salt").repartition(16, "key", "_salt")
    largest = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 2 * 4000 / 16


def test_broadcast_only_after_counting(spark):
    small, large = spark.range(5), spark.range(5000)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(skew.broadcast_if_small(small, 1000))
    assert "ResolvedHint" not in plan(skew.broadcast_if_small(large, 1000))


def test_exact_quantiles_chunked(spark):
    data = [(float(v), float(i) if i % 3 else None) for i, v in enumerate([5, 1, 1, 1, 9, 2, 7, 7, 3, 4] * 7)]
    df = spark.createDataFrame(data, "a double, b double")
    shares = {"low": 0.1, "mid": 0.5, "high": 0.97}
    expected = {n: df.agg(*[F.percentile(n, F.lit(s)) for s in shares.values()]).first() for n in ("a", "b")}
    for limits in ({}, {"rows_per_task": 20}):
        for row in selection.exact_quantiles(df, ["a", "b"], shares, **limits).collect():
            assert [row[n] for n in shares] == pytest.approx(list(expected[row["feature"]]))


def test_median_interpolates(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("v"))
    assert selection.exact_quantiles(df, ["v"], {"m": 0.5}).first()["m"] == 9.5


def test_last_before_first_with_hot_key(spark):
    notes = [(i, "hot", "bot" if i < 700 else "agent", i) for i in range(1000)] + [(2000, "a", "agent", 1), (2001, "a", "bot", 2), (2002, "b", "bot", 3)]
    df = spark.createDataFrame(notes, "id long, key string, who string, at int")
    bot = F.col("who") == "bot"
    for limits in ({}, {"rows_per_task": 100}):
        found = {r["key"]: (r["first"]["id"], r["before"] and r["before"]["id"]) for r in lookups.last_before_first(df, "key", "id", ~bot, bot, ["at"], **limits).collect()}
        assert found == {"hot": (700, 699), "a": (2000, None)}


def test_history_of_missing_and_repeated_people(spark):
    data = [(1, "S1", "A", "$10.5"), (2, None, "B", "7"), (3, "s1", "C", "$3"), (4, None, "D", None), (5, "S1", "E", "bad")]
    df = spark.createDataFrame(data, "id long, social string, type string, salary string")
    expected = [(1, 1, 10.5, None), (2, 0, None, None), (3, 2, 3.0, "A"), (4, 0, None, None), (5, 3, 3.0, "C")]
    for limits in ({}, {"rows_per_task": 3}):
        rows = history.application_history(df, **limits).collect()
        assert sorted((r["id"], r["times_applied"], r["min_salary"] and float(r["min_salary"]), r["previous_type"]) for r in rows) == expected


def test_auc_properties(spark):
    data = [(random.choice([0.1, 0.2, 0.5, 0.5, 0.9]), random.randrange(2)) for _ in range(400)]
    df = spark.createDataFrame(data, "s double, y int")
    wins = sum((a > b) + 0.5 * (a == b) for a, p in data if p for b, n in data if not n)
    pos = sum(y for _, y in data)
    expected = wins / (pos * (len(data) - pos))
    for limits in ({}, {"rows_per_task": 3}):
        assert evaluate.roc_auc(df, "s", "y", **limits).first()["auc"] == pytest.approx(expected)
    assert evaluate.roc_auc(df.withColumn("s", -F.col("s")), "s", "y").first()["auc"] == pytest.approx(1 - expected)
    assert evaluate.roc_auc(df.where("y = 1"), "s", "y").first()["auc"] is None
    assert evaluate.no_skill(df, "y").first()["auc"] == 0.5
    odd = df.unionByName(spark.createDataFrame([(float("nan"), 1), (None, 0), (0.5, None)], "s double, y int"))
    for limits in ({}, {"rows_per_task": 3}):
        assert evaluate.roc_auc(odd, "s", "y", **limits).first()["auc"] == pytest.approx(expected)


def test_bins_cover_all_rows(spark):
    df = spark.createDataFrame([(float(v), v % 2) for v in [0, 0, 0, 0, 0, 1, 2, 3, 50, 100]], "s double, y int")
    edges = evaluate.quantile_edges(df, "s", 10)
    assert edges == sorted(set(edges)) and len(edges) < 11
    binned = evaluate.quantile_bins(df, "s", 10)
    assert binned.where("bin IS NULL").count() == 0 and binned.where("s = 0 AND bin <> 1").count() == 0
    width = evaluate.width_bins(df, "s", "y", 10).orderBy("bin").collect()
    assert sum(r["volume"] for r in width) == 10 and [r["volume"] for r in width] == [8, 0, 0, 0, 1, 0, 0, 0, 0, 1]


def test_lookups_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(ROWS, "id long, key string, value long, tag string")
    first = lambda d: sorted(lookups.first_by(d, "key", "id", ["id", "value"]).collect())
    last = lambda d: sorted(lookups.keep_last(d, "key", "value", "id").collect())
    assert first(df.repartition(1)) == first(df.repartition(7)) and last(df.repartition(1)) == last(df.repartition(7))


def test_a_person_is_one_whatever_the_case(spark):
    applied = [(1, "S1", "A", "2021-01-01"), (2, "s1", "B", "2021-01-03"), (3, "s2", "C", "2021-01-02")]
    applicants = spark.createDataFrame(applied, "id long, social string, type string, dte string").withColumn("dte", F.to_date("dte"))
    leads = spark.createDataFrame([(9, "s1", "2021-01-05 10:00:00"), (8, "S1", "2021-01-02 10:00:00"), (7, "S2", "2021-01-02 10:00:00"), (6, None, None)], "lead_id long, social string, lead_ts string")
    found = {r["lead_id"]: (r["social"], r["prior_count"], r["prior_type"]) for r in history.prior_applications(leads.withColumn("lead_ts", F.to_timestamp("lead_ts")), applicants).collect()}
    assert found == {9: ("s1", 2, "B"), 8: ("S1", 1, "A"), 7: ("S2", 0, ""), 6: (None, 0, "")}


def plain_tree_auc(train, test):
    """A tree of one feature grown until nothing can be split, level by level, and the AUC of its test chances."""
    def grow(rows):
        values, labels = sorted({v for v, _ in rows}), [y for _, y in rows]
        if len(values) == 1 or len(set(labels)) == 1:
            rate = sum(labels) / len(labels)
            return lambda v: rate
        best = None
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            parts = [[y for v, y in rows if (v <= cut) == side] for side in (True, False)]
            score = sum(2 * sum(p) * (len(p) - sum(p)) / len(p) for p in parts)
            if best is None or score < best[0]:
                best = (score, cut)
        low, high = (grow([r for r in rows if (r[0] <= best[1]) == side]) for side in (True, False))
        return lambda v: low(v) if v <= best[1] else high(v)

    tree = grow(train)
    good, bad = [tree(v) for v, y in test if y == 0], [tree(v) for v, y in test if y == 1]
    return sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(good) * len(bad))


def test_single_feature_trees_against_grown_trees(spark):
    random = np.random.default_rng(21)
    make = lambda n: [(float(v) if v > -1.5 else None, float(-y + random.normal() * 0.3), float(random.integers(0, 4)), 1.0, int(y)) for v, y in ((round(random.normal(), 1), random.random() < 0.4) for _ in range(n))]
    train, test = make(160), make(70)
    frames = [spark.createDataFrame(rows, "holes double, falling double, few double, same double, y int").repartition(4) for rows in (train, test)]
    features = ["holes", "falling", "few", "same"]
    found = {r["feature"]: (r["auc"], r["kept"]) for r in evaluate.feature_tree_auc(*frames, features, "y").collect()}
    for place, name in enumerate(features):
        pick = lambda rows: [(0.0 if r[place] is None else r[place], r[-1]) for r in rows]  # noqa: E731, B023
        auc = plain_tree_auc(pick(train), pick(test))
        assert found[name][0] == pytest.approx(auc) and found[name][1] == (auc > 0.5)
    assert found["falling"][1] and found["same"] == (0.5, False)


def test_only_what_is_needed_is_read_for_the_salt(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(k, k % 3, "x" * 50, [k]) for k in range(50)], "id long, k long, wide string, many array<long>").write.parquet(path)
    joined = skew.enrich(spark.read.parquet(path), spark.range(3).select(F.col("id").alias("k")), "k").select("id", "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan and "many" not in plan


def test_id_lists_as_tables(spark):
    from lendloom.operators import membership

    ids = spark.createDataFrame([(3,), (3,), (None,), (40,)], "wanted long")
    assert sorted(r["id"] for r in membership.in_ids(spark.range(10), "id", ids).collect()) == [3]
