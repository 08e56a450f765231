"""Spikes, dips and step changes against a plain implementation."""

import datetime as dt

import numpy as np
import pytest

from basketlab.operators import anomalies as an
from basketlab.operators import forecast as fc


def many(spark, series):
    start = dt.date(2020, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), float(v)) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, InvoiceDate date, Quantity double")


def plain(y):
    """(spike, dip, step, cleaned, steady) by the definitions."""
    n, x = len(y), np.asarray(y, dtype=float)
    window = lambda v, t: np.median(v[max(0, t - 7):t + 8])
    m = np.array([window(x, t) for t in range(n)])
    d = x - m
    a = np.array([window(np.abs(d), t) for t in range(n)])
    spike, dip = (a > 0) & (d > 5 * 1.4826 * a), (a > 0) & (d < -5 * 1.4826 * a)
    x = np.where(spike | dip, m, x)
    noise = np.median(np.abs(np.diff(x))) * 1.4826 / np.sqrt(2) if n > 1 else 0.0
    jump, stretches = np.zeros(n), [(0, n)]
    for _ in range(3):
        new = []
        for s, e in stretches:
            z = x[s:e]
            places = range(13, len(z) - 14)
            far = np.abs(np.cumsum(z - z.mean()))
            best = max(places, key=lambda t: far[t], default=None)
            if best is not None and noise > 0:
                by = z[best + 1:best + 15].mean() - z[best - 13:best + 1].mean()
                if abs(by) >= 5 * noise:
                    jump[s + best + 1] = by
                    new += [(s, s + best + 1), (s + best + 1, e)]
                    continue
            new.append((s, e))
        stretches = new
    return spike, dip, jump != 0, x, x + jump.sum() - np.cumsum(jump)


def check(spark, series):
    got = an.anomalies(many(spark, series), ["k"]).orderBy("InvoiceDate").toPandas()
    for k, y in series.items():
        mine = got[got.k == k]
        for name, want in zip(("spike", "dip", "step", "cleaned", "steady"), plain(y), strict=True):
            have = mine[name].to_numpy()
            assert np.array_equal(have, want) if want.dtype == bool else np.allclose(have, want), (k, name)
    return got


def test_planted_spikes_dips_and_steps(spark):
    rng = np.random.default_rng(4)
    y = 100 + rng.normal(0, 3, 300)
    y[40] += 60
    y[200] -= 70
    one = np.where(np.arange(300) < 120, 50.0, 120.0) + rng.normal(0, 3, 300)
    three = np.repeat([10.0, 60.0, 20.0, 90.0], 80) + rng.normal(0, 2, 320)
    got = check(spark, {"spiky": y, "one": one, "three": three, "noise": rng.normal(0, 1, 400),
                        "line": 0.2 * np.arange(300) + rng.normal(0, 1, 300), "flat": np.full(60, 4.0),
                        "short": np.array([1.0, 9.0, 2.0]), "single": np.array([3.0])})
    at = lambda k, c: np.flatnonzero(got[got.k == k][c].to_numpy()).tolist()
    assert 40 in at("spiky", "spike") and 200 in at("spiky", "dip") and at("spiky", "step") == []
    assert at("one", "step") == [120] and at("three", "step") == [80, 160, 240]
    assert at("noise", "step") == at("line", "step") == at("flat", "spike") == at("short", "step") == []
    steady = got[got.k == "three"]["steady"].to_numpy()
    assert np.std([steady[i:i + 80].mean() for i in (0, 80, 160, 240)]) < 2


@pytest.mark.parametrize("seed", range(3))
def test_random_series(spark, seed):
    rng = np.random.default_rng(seed)
    level = np.repeat(rng.normal(0, 20, 5), 40)
    check(spark, {f"s{i}": level + rng.standard_t(3, 200) for i in range(4)})


def test_season_is_left_out_and_flags(spark):
    rng = np.random.default_rng(9)
    week = np.tile([0.0, 10.0, 20.0, 30.0, 5.0, -25.0, -40.0], 40)
    y = 200 + week + rng.normal(0, 2, 280)
    y[100] += 80
    step = 200 + week + rng.normal(0, 2, 280) + np.where(np.arange(280) < 140, 0, 90)
    df = many(spark, {"a": y, "b": step})
    found = an.anomalies(fc.seasonal_trend(df, ["k"]), ["k"])
    flags = {r.k: r for r in an.flags(found, ["k"]).collect()}
    assert flags["a"].has_spikes_and_dips and not flags["a"].has_step_changes and flags["b"].has_step_changes
    rows = fc.arima_evaluate(df, ["k"], flags=an.flags(found, ["k"])).collect()
    assert {(r.k, r.has_step_changes) for r in rows} >= {("a", False), ("b", True)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_and_unnamed(spark):
    df = many(spark, {})
    assert an.anomalies(df, ["k"]).count() == 0
    y = np.where(np.arange(100) < 50, 1.0, 30.0) + np.random.default_rng(1).normal(0, 1, 100)
    got = an.anomalies(many(spark, {"x": y}).drop("k")).orderBy("InvoiceDate").toPandas()
    assert np.flatnonzero(got["step"].to_numpy()).tolist() == [50]
