"""Learners, elimination, scoring in batch and as a stream."""

import datetime as dt
import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lendloom.operators import boosting, evaluate, models
from lendloom.plans.scoring import Scorer, assemble_applicants, fit_scorer, score, source_columns
from lendloom.sources.files import request_json
from lendloom.streaming.requests import deliver, delivered, read_requests, score_stream, write_scores
from lendloom.workload.learning import cut_flags, parts, request_parts, tuned_boosting_scores

SMOKE_FOLDER = "/root/testdata/sf0.001"

FEATURES = ["a", "b", "noise"]


@pytest.fixture(scope="module")
def sample(spark):
    random.seed(3)
    rows = []
    for i in range(600):
        a, b = random.random(), random.random()
        rows.append((i, a, b, random.random(), int(a + 0.5 * b + 0.3 * random.random() > 0.9)))
    return spark.createDataFrame(rows, "id int, a double, b double, noise double, y int").cache()


@pytest.mark.parametrize(
    "fit",
    [
        lambda *a: models.fit_boosted(*a, rounds=5),
        lambda *a: models.fit_tuned_boosting(*a, rounds=5),
        lambda *a: models.fit_forest(*a, trees=10),
        lambda *a: models.fit_adaptive(*a, rounds=4, cut_every=2),
        models.fit_logistic,
    ],
)
def test_better_than_no_skill(sample, fit):
    scored = models.add_scores(fit(sample, FEATURES, "y"), sample)
    row = evaluate.roc_auc(scored, "prob_1", "y").first()
    assert row["auc"] > 0.8
    assert scored.where("abs(prob_0 + prob_1 - 1) > 1e-9 OR abs(score - 1000 * prob_0) > 1e-9").count() == 0
    assert scored.where("(prob_1 > 0.5) <> (predicted = 1) AND prob_1 <> 0.5").count() == 0


def test_saved_model_gives_equal_scores(sample, tmp_path):
    model = models.fit_boosted(sample, FEATURES, "y", rounds=3)
    models.save_model(model, str(tmp_path / "m"))
    pick = lambda m: sorted(models.add_scores(m, sample).select("id", "score").collect())
    assert pick(models.load_model(str(tmp_path / "m"))) == pick(model)


def test_elimination_agrees_with_linear_regression(spark, sample):
    def p_values(names):
        data = VectorAssembler(inputCols=names, outputCol="features").transform(sample)
        return LinearRegression(labelCol="y", solver="normal").fit(data).summary.pValues[: len(names)]

    left = list(FEATURES)
    while left:
        tails = p_values(left)
        if max(tails) <= 0.05:
            break
        left.pop(tails.index(max(tails)))
    kept = models.backward_elimination(sample, FEATURES, "y")
    assert [name for name, _ in kept] == left
    assert [p for _, p in kept] == pytest.approx(p_values(left), abs=1e-9)
    loose = models.backward_elimination(sample, FEATURES, "y", level=1.0)
    assert [p for _, p in loose] == pytest.approx(p_values(FEATURES), abs=1e-6)


def test_logit_table_and_importances(spark, sample):
    table = {r["feature"]: r for r in models.logit_table(sample, FEATURES, "y").collect()}
    assert table["a"]["p_value"] < 0.05 and table["a"]["odds_ratio"] > 1
    model = models.fit_forest(sample, FEATURES, "y", trees=10)
    assert models.important_features(model, FEATURES, top=1) == ["a"]
    assert "noise" not in models.important_features(model, FEATURES, at_least=0.2)
    assert models.important_features(models.fit_logistic(sample, FEATURES, "y"), FEATURES, top=2) == ["a", "b"]


COLUMNS = {"features": ("n", "match", "seendiff", "Bank", "kind"), "labels": ("Bank", "kind"), "percent": ("match",), "dates": ("seen",), "bank": "Bank"}
REQUEST = {"id": "int", "n": "double", "match": "string", "seen": "string", "Bank": "string", "kind": "string"}
def as_of():
    return F.lit(dt.date(2021, 6, 30))



@pytest.fixture(scope="module")
def applicants(spark):
    rows = [
        (i, float(i % 17) if i % 5 else None, f"{i % 100}%" if i % 7 else None, f"{1 + i % 12}/3/2021" if i % 3 else None, "my chase" if i % 2 else "pnc x",
         "k" + str(i % 3), int(i % 17 > 8))
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "id int, n double, match string, seen string, Bank string, kind string, y int").cache()


@pytest.fixture(scope="module")
def scorer(applicants):
    return fit_scorer(applicants, "y", as_of(), lambda *a: models.fit_boosted(*a, rounds=3), **COLUMNS)


def test_inputs_come_back_as_they_were(applicants, scorer):
    scored = score(applicants, scorer, "id", as_of())
    assert scored.columns == ["id", "n", "match", "seen", "Bank", "kind", "predicted", "prob_0", "prob_1", "score"]
    inputs = list(REQUEST)
    assert sorted(scored.select(*inputs).collect(), key=str) == sorted(applicants.select(*inputs).collect(), key=str)
    assert scored.where("score IS NULL").count() == 0


def test_new_labels_and_missing_values_are_scored(spark, scorer):
    new = spark.createDataFrame([(1, None, None, None, None, "never seen")], "id int, n double, match string, seen string, Bank string, kind string")
    assert 0 <= score(new, scorer, "id", as_of()).first()["score"] <= 1000


def test_stream_equals_batch(spark, applicants, scorer, tmp_path):
    folder = str(tmp_path)
    request_json(applicants, list(REQUEST)).select("json").write.text(f"{folder}/in")
    stream = score_stream(read_requests(spark, f"{folder}/in", REQUEST), scorer, "id", as_of())
    assert stream.isStreaming
    write_scores(stream, f"{folder}/out", f"{folder}/progress").awaitTermination()
    pick = lambda df: sorted(df.select("id", "score", "predicted").collect())
    assert pick(spark.read.parquet(f"{folder}/out")) == pick(score(applicants, scorer, "id", as_of()))


def test_saved_scorer(spark, applicants, scorer, tmp_path):
    scorer.save(str(tmp_path / "s"))
    loaded = Scorer.load(spark, str(tmp_path / "s"))
    assert loaded.default_rate == scorer.default_rate and tuple(loaded.features) == COLUMNS["features"]
    pick = lambda s: sorted(score(applicants, s, "id", as_of()).select("id", "score").collect())
    assert pick(loaded) == pick(scorer)


def test_source_columns():
    assert source_columns(["a", "seendiff", "Bank"]) == ["a", "seen", "Bank"]


def test_assembled_applicants(spark):
    bureau = spark.createDataFrame([(1, 700), (2, 600)], "application_id int, risk int")
    job = '[{"EmploymentStatus":"Active","CurrDateAsOf":"1/1/2021","PeriodPaymentInfo":"Weekly","PeriodIncome":"12"},{"a":1},{"b":2}]'
    customers = spark.createDataFrame([(1, "CA", job), (2, "CA", None), (3, "TX", job)], "applicant_id int, state string, employment_response string")
    row = assemble_applicants(bureau, customers).collect()
    assert [(r["application_id"], r["state_name"], r["employer_count"], r["active_count"], r["monthly_income"]) for r in row] == [(1, "California", 1, 1, 52.0)]


def plain_real_boosting(rows, edges, rounds):
    """Real-valued boosting with stumps in plain Python: (feature, edge) of every round and the margins."""
    import numpy as np

    values, y = np.array([r[:-1] for r in rows], float), np.array([r[-1] for r in rows])
    margin, chosen = np.zeros(len(rows)), []
    for _ in range(rounds):
        w, best = np.exp(-0.5 * (2 * y - 1) * margin), None
        for f in range(values.shape[1]):
            for edge in edges[f]:
                left = values[:, f] <= edge
                sides = [(w[m & (y == 1)].sum(), w[m & (y == 0)].sum()) for m in (left, ~left)]
                score = sum(2 * a * b / (a + b) for a, b in sides if a + b > 0)
                if best is None or score < best[0] * (1 - 1e-12):
                    best = (score, f, edge, left, sides)
        odds = [np.log(p / (1 - p)) for p in (min(max(a / (a + b), models.CHANCE_FLOOR), 1 - models.CHANCE_FLOOR) for a, b in best[4])]
        margin += np.where(best[3], *odds)
        chosen.append((best[1], best[2]))
    return chosen, margin


def test_real_adaptive_boosting_against_plain_python(spark):
    import numpy as np

    random = np.random.default_rng(12)
    rows = [(float(a), float(b), int(random.random() < 1 / (1 + np.exp(-(a - 1.2 * b * b + 1))))) for a, b in random.normal(size=(500, 2)).round(2)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = models.fit_real_adaptive(df, ["a", "b"], "y", rounds=7, bins=12, cut_every=3)
    edges = models.bin_edges(df, ["a", "b"], 12)
    chosen, margin = plain_real_boosting(rows, [edges["a"], edges["b"]], 7)
    assert [(s.feature, s.threshold) for s in model.stumps] == [("ab"[f], e) for f, e in chosen]
    decided = [r["d"] for r in df.coalesce(1).select(model.decision().alias("d")).collect()]
    assert sorted(decided) == pytest.approx(sorted(margin / 7))
    again = models.fit_real_adaptive(df.repartition(5), ["a", "b"], "y", rounds=7, bins=12)
    assert [(s.feature, s.threshold) for s in again.stumps] == [(s.feature, s.threshold) for s in model.stumps]
    scored = models.add_scores(model, df).collect()
    assert all(abs(r["prob_0"] + r["prob_1"] - 1) < 1e-9 and (r["prob_1"] > 0.5) == (r["predicted"] == 1) for r in scored)


def test_real_adaptive_boosting_needs_a_split(spark):
    with pytest.raises(ValueError, match="two values"):
        models.fit_real_adaptive(spark.createDataFrame([(1.0, 0), (1.0, 1)], "a double, y int"), ["a"], "y")
    perfect = models.fit_real_adaptive(spark.createDataFrame([(float(k), int(k > 3)) for k in range(9)], "a double, y int"), ["a"], "y", rounds=4, bins=9)
    assert perfect.stumps[0].threshold in (3.0, 3.5) or 3 <= perfect.stumps[0].threshold < 4


def test_scores_and_rejects_of_one_read(spark, applicants, scorer, tmp_path):
    """Bad lines among good ones; a stream that stops and goes on; a batch that runs again after its writes."""
    import glob
    import os

    folder = str(tmp_path)
    sinks = (f"{folder}/scores", f"{folder}/rejects", f"{folder}/progress")
    run = lambda: deliver(spark, f"{folder}/in", REQUEST, scorer, "id", as_of(), *sinks, files_per_trigger=1).awaitTermination()
    lines = request_json(applicants, list(REQUEST)).select("json")
    lines.limit(20).coalesce(1).write.text(f"{folder}/in")
    run()
    lines.exceptAll(lines.limit(20)).coalesce(2).write.mode("append").text(f"{folder}/in")
    spark.createDataFrame([('{"id":[1',), ("no request",), ('{"id":[]}',)], "json string").coalesce(1).write.mode("append").text(f"{folder}/in")
    run()
    pick = lambda df: sorted(df.select("id", "score", "predicted").collect())
    expected = pick(score(applicants, scorer, "id", as_of()))
    assert pick(delivered(spark, sinks[0])) == expected
    assert sorted(r["reason"] for r in delivered(spark, sinks[1]).collect()) == ["empty", "malformed", "malformed"]
    last = max(glob.glob(f"{folder}/progress/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)  # as if the process had ended between the last write and its commit
    for leftover in glob.glob(f"{folder}/progress/commits/.{os.path.basename(last)}.crc"):
        os.remove(leftover)
    run()
    assert pick(delivered(spark, sinks[0])) == expected and delivered(spark, sinks[1]).count() == 3


def test_an_empty_selection_is_a_row_and_not_an_error():
    none = {"a": 0.0, "b": 0.0}  # trees without a split
    assert cut_flags(none, [], {"at_least": 0.01}) == (0, 0)
    assert cut_flags({"a": 0.9, "b": 0.1}, ["a"], {"at_least": 0.2}) == (1, 1)
    assert cut_flags({"a": 0.9, "b": 0.1}, ["b"], {"at_least": 0.01})[0] == 0


def test_parts_are_joined_once(spark):
    for part in (*parts(spark, SMOKE_FOLDER), *request_parts(spark, SMOKE_FOLDER)):
        assert "Join" not in part._jdf.queryExecution().optimizedPlan().toString()


def test_tuned_boosting_runs_all_rounds(spark, monkeypatch):
    """The query fits the 3,000 trees of the tuned settings, and scores with all of them."""
    fitted, fit = [], models.fit_tuned_boosting
    monkeypatch.setattr(models, "fit_tuned_boosting", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    flags = tuned_boosting_scores(spark, SMOKE_FOLDER).collect()
    (model,) = fitted
    assert model.stages[-1].getNumTrees == model.stages[-1].getMaxIter() == 3000
    assert flags and all(r["sums_to_one"] == r["is_scaled"] == r["is_decided"] == 1 for r in flags)


@pytest.fixture(scope="module")
def whole_numbers(spark):
    random.seed(8)
    rows = [(float(random.randrange(9)), float(random.randrange(20)), random.randrange(2)) for _ in range(500)]
    rows = [(a, b, float(a + b / 2 + 4 * noise > 9)) for a, b, noise in rows]
    return spark.createDataFrame(rows, "a double, b double, y double").coalesce(1).cache()


def test_trees_are_those_of_spark_ml(whole_numbers):
    """Without drawing rows and features by lot, every score is the one of GBTClassifier."""
    settings = boosting.Settings(width=2, rounds=12, depth=4, least=7, share=1.0, step=0.1, seed=1)
    assert settings.subset == 2
    learner = GBTClassifier(labelCol="y", maxIter=12, maxDepth=4, stepSize=0.1, minInstancesPerNode=7, seed=1)
    spark_ml, names = models._fit(learner, whole_numbers, ["a", "b"], "y"), ["a", "b"]
    edges = models.split_candidates(whole_numbers, names, boosting.BINS)
    assert edges == [[k + 0.5 for k in range(8)], [k + 0.5 for k in range(19)]]
    own = boosting.with_trees(spark_ml, whole_numbers.sparkSession, boosting.boosted_trees(whole_numbers, edges, settings), edges, settings)
    pick = lambda model: [r["prob_1"] for r in models.add_scores(model, whole_numbers).collect()]
    assert pick(own) == pytest.approx(pick(spark_ml), abs=1e-9)
    assert own.stages[-1].featureImportances.toArray() == pytest.approx(spark_ml.stages[-1].featureImportances.toArray())
    assert [t.numNodes for t in own.stages[-1].trees] == [t.numNodes for t in spark_ml.stages[-1].trees]


def test_dealt_blocks_give_the_same_trees(whole_numbers, monkeypatch):
    monkeypatch.setattr(boosting, "CUT_EVERY", 2)
    edges = models.split_candidates(whole_numbers, ["a", "b"], boosting.BINS)
    near = lambda left, right: all(x == pytest.approx(y) for x, y in zip(left, right, strict=True))
    drawn = boosting.Settings(width=2, rounds=5, depth=4, least=7, share=0.8, step=0.1, seed=1)
    assert near(boosting.boosted_trees(whole_numbers, edges, drawn), boosting.boosted_trees(whole_numbers, edges, drawn, one_task_bytes=1))
    full = boosting.Settings(width=2, rounds=5, depth=4, least=7, share=1.0, step=0.1, seed=1)
    several = boosting.boosted_trees(whole_numbers.repartition(3), edges, full, one_task_bytes=1)
    assert len(several) == 5 and near(several, boosting.boosted_trees(whole_numbers, edges, full))


def test_tuned_boosting_without_a_split(spark):
    same = spark.createDataFrame([(1.0, k % 2) for k in range(40)], "a double, y int")
    scores = {r["prob_1"] for r in models.add_scores(models.fit_tuned_boosting(same, ["a"], "y", rounds=3), same).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1
    with pytest.raises(Exception, match="(?i)null"):
        models.fit_tuned_boosting(spark.createDataFrame([(1.0, 0), (None, 1)], "a double, y int"), ["a"], "y", rounds=3)
