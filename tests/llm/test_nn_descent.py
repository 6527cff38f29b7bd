import brute
import numpy as np
import pytest

from lendloom.llm.nn_descent import near_duplicates


def plain(rows, threshold=0.9):
    good = {}
    for key, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, float)
            good[key] = v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())
    keys = sorted(good)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[:i] if len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold]
    of = brute.components([k for k, _ in rows], links)
    return {k: (sum(k in link for link in links), of[k], of[k] == k) for k, _ in rows}


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(3)
    out = [random.standard_normal(24) for _ in range(250)]
    for spread, size in ((0.02, 150), (0.09, 60), (0.0, 40)):
        center = random.standard_normal(24)
        out += [center + spread * random.standard_normal(24) for _ in range(size)]
    out += [out[k] + 0.05 * random.standard_normal(24) for k in range(30)]
    listed = [(10 + i, v.tolist()) for i, v in enumerate(out)]
    return [*listed, (1, None), (2, []), (3, [0.0] * 24), (4, [None] + [1.0] * 23), (5, [float("nan")] * 24), (6, [float("inf")] + [0.0] * 23), (7, [1e-300, 0.0]), (8, [1e300, 1e299]), (9, [1.0, 0.0])]


@pytest.mark.parametrize("small", [512, 40])
def test_same_as_plain(spark, rows, monkeypatch, small):
    import lendloom.llm.nn_descent as module

    monkeypatch.setattr(module, "SMALL", small)
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<double>, n_links int").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}
    expected = plain(rows)
    # Recall of the graph is measured, not assumed: at least 0.9 of the links, and nothing invented.
    found, true = sum(g[0] for g in got.values()), sum(e[0] for e in expected.values())
    assert got.keys() == expected.keys() and all(got[k][0] <= expected[k][0] for k in got)
    assert found >= 0.98 * true


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_links_of_tight_groups(spark):
    """Two groups that fill one another's lists with their own members are still linked, as every pair across is over the threshold."""
    random = np.random.default_rng(5)
    axis = np.eye(24)
    centers = axis[0], 0.93 * axis[0] + np.sqrt(1 - 0.93 ** 2) * axis[1]
    out = [c + 0.004 * random.standard_normal(24) for c in centers for _ in range(400)] + [random.standard_normal(24) for _ in range(300)]
    rows = [(i, v.tolist()) for i, v in enumerate(out)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()}
    assert got == plain(rows)


def test_hot_group_does_not_hide_small_ones(spark):
    """A vector with many found links does not make up for small components with missed ones."""
    from lendloom.llm.nn_descent import short_strata

    hot = spark.range(100_000).selectExpr("1L AS a", "id + 10 AS b", "3L AS stratum", "false AS missed")
    small = spark.range(100).selectExpr("-id - 1 AS a", "-id - 1000 AS b", "1L AS stratum", "id < 30 AS missed")
    assert short_strata(hot.unionByName(small)) == [(1, 100, 30)]
