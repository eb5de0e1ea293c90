"""Quantiles and gaps by bucket refinement against numpy over all values."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import drift, preprocess
from holdfast.operators.refine import quantiles, refine

SPLITS, PAIRS = ("a", "b", "c"), [(0, 1), (0, 2), (1, 2)]


def columns(n: int) -> dict[str, list[float | None]]:
    dice = np.random.default_rng(4)
    skewed = dice.lognormal(0, 4, n)
    skewed[0] = 1e12
    infinite = dice.normal(size=n)
    infinite[:9] = [np.inf] * 3 + [-np.inf] * 6
    gaps = dice.normal(size=n)
    return {
        "smooth": list(dice.normal(size=n)), "skewed": list(skewed), "ties": list(np.round(dice.normal(size=n))), "constant": [2.5] * n,
        "infinite": list(infinite), "holes": [None if i % 3 == 0 else float(v) for i, v in enumerate(gaps)], "missing": [None] * n,
        "one_split": [float(v) if i % 3 == 0 else None for i, v in enumerate(gaps)],
    }


@pytest.fixture(scope="module")
def frame(spark):
    data = columns(3000)
    rows = [(SPLITS[i % 3], *(None if data[c][i] is None else float(data[c][i]) + (0.3 if i % 3 == 1 and c == "smooth" else 0.0) for c in data)) for i in range(3000)]
    return spark.createDataFrame(rows, "split_name string, " + ", ".join(f"{c} double" for c in data)).repartition(4).cache(), list(data), rows


@pytest.mark.parametrize("buckets", [2048, 3])
def test_quantiles_and_gaps_equal_numpy(frame, buckets):
    df, names, rows = frame
    refined = refine(df, "split_name", SPLITS, names, drift.DECILES, [0, 1], PAIRS, buckets)
    got = {(r.feature, r.ref, r.quantile_index): r.quantile for r in quantiles(refined, drift.DECILES, [0, 1]).collect()}
    totals = drift.with_means(refined.totals, 3)
    gaps = {r.feature: r for r in drift.ks_distances(refined, totals, PAIRS).collect()}
    for at, name in enumerate(names, start=1):
        parts = [np.sort([r[at] for r in rows if r[0] == s and r[at] is not None]) for s in SPLITS]
        if name != "infinite":
            for ref in (0, 1):
                for i, p in enumerate(drift.DECILES):
                    if len(parts[ref]):
                        assert got[name, ref, i] == pytest.approx(np.quantile(parts[ref], p), rel=1e-12, abs=1e-12)
                    else:
                        assert (name, ref, i) not in got
        for r, c in PAIRS:
            if len(parts[r]) and len(parts[c]):
                both = np.concatenate((parts[r], parts[c]))
                share = lambda x: np.searchsorted(x, both, side="right") / len(x)
                assert gaps[name][f"ks_{r}_{c}"] == pytest.approx(np.abs(share(parts[r]) - share(parts[c])).max(), abs=1e-12)


def test_only_buckets_that_matter_are_refined(frame):
    df, _, _ = frame
    refined = refine(df, "split_name", SPLITS, ["smooth"], drift.DECILES, [0], PAIRS)
    assert refined.ranked.count() < 0.2 * 3000


def test_psi_shuffles_no_values(frame):
    df, _, _ = frame
    refined = refine(df, "split_name", SPLITS, ["smooth", "ties"], drift.DECILES, [0], PAIRS[:2])
    psi = drift.binned_psi(refined, drift.with_means(refined.totals, 3), drift.decile_edges(refined, [0]), PAIRS[:2])
    plan = psi._jdf.queryExecution().executedPlan().toString()
    assert "value#" not in " ".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_empty_table_and_medians(frame):
    df, names, rows = frame
    assert quantiles(refine(df.limit(0), "split_name", SPLITS, names, [0.5], [0]), [0.5], [0]).count() == 0
    medians = {r.feature: r.fill_value for r in preprocess.numeric_medians(df, ["smooth", "skewed", "holes", "missing"]).collect()}
    for at, name in enumerate(names, start=1):
        if name in medians:
            values = [r[at] for r in rows if r[at] is not None]
            assert medians[name] == pytest.approx(np.median(values) if values else 0.0)
    assert df.filter(F.col("missing").isNotNull()).count() == 0


def test_ranked_values_come_from_the_stored_profile_not_from_another_scan(spark, monkeypatch):
    from holdfast.operators import refine as module

    read, real = {}, module.materialize

    def seen(df, name):
        read[name] = df.inputFiles()
        return real(df, name)

    monkeypatch.setattr(module, "materialize", seen)
    rows = spark.createDataFrame([("a" if i % 2 else "b", float(i % 97)) for i in range(1000)], "s string, x double")
    module.refine(rows, "s", ["a", "b"], ["x"], [0.5], [0], [(0, 1)])
    assert read["refined_profile"] and not any("/numeric_values" in f for f in read["refined_profile"])
