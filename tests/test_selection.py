"""Exact quantiles by selection against sorted values, through every size of what is kept."""

import numpy as np
import pytest

from lendloom.operators import selection

SHARES = {"low": 0.0, "q10": 0.1, "q25": 0.25, "mid": 0.5, "q9": 0.9, "top": 1.0}


def frame(spark, rows):
    random = np.random.default_rng(4)
    data = {
        "smooth": random.normal(size=rows) * 1e6, "few": random.integers(0, 5, rows).astype(float), "same": np.full(rows, 7.0),
        "holes": np.where(random.random(rows) < 0.4, np.nan, random.exponential(size=rows)), "heavy": np.where(random.random(rows) < 0.7, 1.5, random.random(rows) * 3),
    }
    return spark.createDataFrame([tuple(float(x) for x in r) for r in zip(*data.values())], ", ".join(f"{c} double" for c in data)).repartition(5), data


@pytest.mark.parametrize("rows, kept", [(1, 10), (2, 10), (37, 3), (3000, 1_000_000), (30_000, 1_000_000), (30_000, 20), (30_000, 1)])
def test_against_sorted_values(spark, rows, kept):
    df, data = frame(spark, rows)
    found = {r["feature"]: r for r in selection.exact_quantiles(df, list(data), SHARES, rows_per_task=kept).collect()}
    for name, values in data.items():
        values = values[~np.isnan(values)]
        if not len(values):
            assert name not in found
            continue
        assert found[name]["n"] == len(values)
        for label, share in SHARES.items():
            assert found[name][label] == pytest.approx(np.quantile(values, share), rel=1e-12, abs=1e-12)


def test_brackets_keep_few_values_and_nothing_is_sorted(spark):
    df, data = frame(spark, 100_000)
    extents = selection.measure(df, ["smooth"], [0.25, 0.5])
    kept = selection._kept(df.select("smooth"), extents)
    assert kept.where("value IS NOT NULL").count() < 0.003 * 100_000
    assert "rangepartitioning" not in kept._jdf.queryExecution().toString()


def test_too_narrow_brackets_are_drawn_again(spark):
    df, data = frame(spark, 40_000)
    row = selection.quantiles_of(df, ["smooth"], {"m": 0.5}, margin=1e-9)[0].first()
    assert row["m"] == pytest.approx(np.quantile(data["smooth"], 0.5))


def test_nothing_to_rank(spark):
    none = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert selection.exact_quantiles(none, ["a"], SHARES).count() == 0 and selection.exact_quantiles(none.limit(0), ["a"], SHARES).count() == 0
