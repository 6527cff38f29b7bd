import random

import brute
import pytest

from lendloom.llm.jaccard_join import Plan, jaccard_components, most_difference


def texts():
    random.seed(5)
    words = [f"v{i}" for i in range(400)]
    out, base = [], {n: [random.choice(words) for _ in range(n)] for n in (3, 5, 6, 9, 14, 40, 150, 900)}
    for n, own in base.items():
        for k in range(14):
            changed = list(own)
            for _ in range(random.randint(0, max(1, n // 25))):
                changed[random.randrange(n)] = random.choice(words)
            if k % 4 == 0:
                changed += random.choices(words, k=random.randint(0, n // 6))
            out.append(" ".join(changed))
    passage = " ".join(random.choices(words, k=60))
    out += [f"{' '.join(random.choices(words, k=60))} {passage} {' '.join(random.choices(words, k=30))}" for _ in range(40)]
    return [*out, None, "", " \n ", "One Two", "one  two", out[50], "w " * 30_000]


def test_same_as_plain(spark):
    rows = list(enumerate(texts(), 100))
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, n_shingles int").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()}
    assert got == brute.jaccard_components(rows)


@pytest.mark.parametrize("delete", [False, True])
def test_pigeonhole_holds(delete):
    """Any two sets that link share a signature, on both kinds of allocation."""
    import numpy as np

    random.seed(1)
    plan = Plan(700, 80, {})
    if delete:
        plan.parts = [((plan.need(b, plan.starts[b + 1] - 1) + 2) // 2, 0, True) for b in range(len(plan.starts) - 1)]
    for _ in range(400):
        a = random.choice([1, 2, 4, 5, 7, 12, 30, 85, 300, 550])
        common = random.randint((4 * a + 4) // 5, a)
        b = max(common, min(int(a / 0.8), random.randint(common, common + a // 4 + 1)))
        if 100 * common < 80 * (a + b - common):
            continue
        x, y = [np.array(random.sample(range(1 << 60), n), np.uint64) for n in (a, b)]
        y[:common] = x[:common]
        assert len(np.intersect1d(plan.sign(np.sort(x)), plan.sign(np.sort(y)))), (a, b, common)


def test_most_difference():
    assert [most_difference(a, b) for a, b in ((4, 5), (5, 5), (8, 10), (4, 8), (3, 4))] == [1, 0, 2, -1, -1]


def test_empty_and_repeated_ids(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f")]
    got = sorted(tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_one_python_step_a_task(spark, monkeypatch):
    """What the components begin with is a Python step: the links they get come from a table, not from another such step."""
    from lendloom.llm import jaccard_join

    plans, plain = [], jaccard_join.components
    monkeypatch.setattr(jaccard_join, "components", lambda links: plans.append(links._jdf.queryExecution().optimizedPlan().toString()) or plain(links))
    jaccard_components(spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f h")], "doc_id long, text string")).collect()
    assert len(plans) >= 2 and not any("MapIn" in plan for plan in plans)


def test_pair_of_many_buckets_is_passed_on_once(spark, monkeypatch):
    """Tasks pass on a pair about once, however many buckets hold it; nothing is lost by that."""
    from lendloom.llm import jaccard_join

    rows = [(1, " ".join(f"p{i}" for i in range(130)))] + [
        (10 + i, " ".join([*(f"p{j}" for j in range(100)), *(f"q{i}x{j}" for j in range(11))])) for i in range(30)]
    frame = type(spark.range(0))
    passed, plain = [], frame.distinct
    rest = jaccard_join._rest

    def counted(*args):
        with monkeypatch.context() as m:
            m.setattr(frame, "distinct", lambda self: passed.append(self) or plain(self))
            out = rest(*args)
        return out

    monkeypatch.setattr(jaccard_join, "_rest", counted)
    monkeypatch.setattr(jaccard_join, "_stars", lambda shared: shared.limit(0).selectExpr("doc a", "doc b"))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1} | {10 + i: 10 for i in range(30)}
    assert passed[-1].count() <= 1.5 * passed[-1].dropDuplicates().count()
