"""Forecasting: coefficient recovery, trend, interval growth and coverage."""

import datetime as dt
from collections import Counter

import numpy as np
import pytest

from basketlab.operators import forecast as fc


def series_df(spark, values, key="s", start=dt.date(2020, 1, 1)):
    rows = [(key, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, InvoiceDate date, Quantity double")


def ar_series(phi, n, seed, c=100.0, sd=1.0):
    rng = np.random.default_rng(seed)
    y = np.zeros(n + 200)
    for t in range(len(y)):
        y[t] = sum(p * y[t - 1 - i] for i, p in enumerate(phi) if t - 1 - i >= 0) + rng.normal(0, sd)
    return y[200:] + c


def many(spark, series):
    """{key: values} as one table of gapless daily series."""
    start = dt.date(2020, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), float(v)) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, InvoiceDate date, Quantity double")


def yule_walker(x, p):
    """Coefficients and innovation variance from the linear equations."""
    x = np.asarray(x, dtype=float)
    r = [float((x[k:] * x[:len(x) - k]).sum()) / len(x) for k in range(p + 1)]
    phi = np.linalg.solve([[r[abs(i - j)] for j in range(p)] for i in range(p)], r[1:]) if p else np.array([])
    return phi, r[0] - float(phi @ r[1:p + 1]) if p else r[0]


def test_candidates_solve_the_yule_walker_equations(spark):
    y = ar_series([0.5, -0.3], 300, 1)
    rows = fc.arima_evaluate(series_df(spark, y), ["k"]).filter("non_seasonal_q = 0").collect()
    assert sorted(r.non_seasonal_p for r in rows) == list(range(fc.MAX_ORDER + 1))
    x = np.diff(y, n=rows[0].non_seasonal_d)
    for r in rows:
        assert r.n_points == len(x) and np.isclose(r.intercept_or_drift, x.mean())
        phi, var = yule_walker(x - x.mean(), r.non_seasonal_p)
        assert np.allclose(r.ar_coefficients, phi) and np.isclose(r.variance, var)
        ll = -len(x) / 2 * (np.log(2 * np.pi * var) + 1)
        assert np.isclose(r.log_likelihood, ll) and np.isclose(r.AIC, 2 * (r.non_seasonal_p + 2) - 2 * ll)


def hannan_rissanen(z, p, q):
    """Least squares on lagged values and the shocks of an AR(7), written out:
    (ar, ma, squared error, squared error of the same p without shocks)."""
    long, _ = yule_walker(z, 7)
    e = np.full(len(z), np.nan)
    for t in range(7, len(z)):
        e[t] = z[t] - long @ z[t - 7:t][::-1]
    at = np.arange(9, len(z))
    columns = [e[at - i] for i in range(1, q + 1)] + [z[at - i] for i in range(1, p + 1)]
    x = np.column_stack(columns)
    b = np.linalg.lstsq(x, z[at], rcond=None)[0]
    plain = np.column_stack([z[at - i] for i in range(1, p + 1)]) if p else np.zeros((len(at), 0))
    sse = lambda m, c: float(((z[at] - m @ c) ** 2).sum())
    return b[q:], b[:q], sse(x, b), sse(plain, np.linalg.lstsq(plain, z[at], rcond=None)[0] if p else np.zeros(0)), e


def admissible(ar, ma):
    """No root of either polynomial in or on the unit circle."""
    outside = lambda c: np.all(np.abs(np.roots([*c[::-1], 1.0])) > 1) if len(c) else True
    return bool(outside(-np.asarray(ar)) and outside(np.asarray(ma)))


def ma_series(theta, n, seed, c=100.0):
    e = np.random.default_rng(seed).normal(size=n + 10)
    return np.array([e[t] + sum(b * e[t - 1 - i] for i, b in enumerate(theta)) for t in range(10, n + 10)]) + c


@pytest.mark.parametrize("kind", ["ma1", "ma2", "arma", "walk"])
def test_moving_average_candidates_against_least_squares(spark, kind):
    rng = np.random.default_rng(3)
    y = {"ma1": ma_series([0.6], 300, 2), "ma2": ma_series([0.5, 0.3], 250, 4),
         "arma": ar_series([0.5], 300, 5) + ma_series([0.4], 300, 6), "walk": np.cumsum(ma_series([-0.5], 300, 7, c=0.2)
                                                                                  + rng.normal(0, 0.1, 300))}[kind]
    rows = {(r.non_seasonal_p, r.non_seasonal_q): r
            for r in fc.arima_evaluate(series_df(spark, y), ["k"]).collect()}
    d = rows[0, 0].non_seasonal_d
    assert {r.non_seasonal_d for r in rows.values()} == {d}
    x = np.diff(y, n=d)
    z = x - (x.mean() if d < 2 else 0)
    for p in range(6):
        for q in (1, 2):
            ar, ma, sse, plain, e = hannan_rissanen(z, p, q)
            assert ((p, q) in rows) == admissible(ar, ma), (p, q)
            if (p, q) in rows:
                r = rows[p, q]
                assert np.allclose(r.ar_coefficients, ar, atol=1e-7) and np.allclose(r.ma_coefficients, ma, atol=1e-7)
                assert np.isclose(r.variance, rows[p, 0].variance * sse / plain)
                ll = -len(x) / 2 * (np.log(2 * np.pi * r.variance) + 1)
                assert np.isclose(r.AIC, 2 * (p + q + 1 + (d < 2)) - 2 * ll)
                assert np.allclose(r.last_shocks, [e[-1], e[-2]])


def test_order_search_finds_moving_averages(spark):
    series = {f"{i}": ma_series([0.6], 800, 50 + i) for i in range(8)}
    best = fc.fit_arima(many(spark, series), ["k"]).collect()
    assert len(best) == 8 and {r.non_seasonal_d for r in best} == {0}
    one = [r for r in best if (r.non_seasonal_p, r.non_seasonal_q) == (0, 1)]
    orders = Counter((r.non_seasonal_p, r.non_seasonal_q) for r in best)
    assert orders.most_common(1)[0][0] == (0, 1) and all(abs(r.ma_coefficients[0] - 0.6) < 0.12 for r in one)
    assert all(r.non_seasonal_q > 0 for r in best)


def test_kpss_statistic(spark):
    y = ar_series([0.5], 200, 4)
    z = y - y.mean()
    long_run = (z @ z + 2 * sum((1 - k / (fc.KPSS_LAGS + 1)) * (z[k:] @ z[:-k])
                                for k in range(1, fc.KPSS_LAGS + 1))) / len(z)
    want = (np.cumsum(z) ** 2).sum() / (len(z) ** 2 * long_run)
    rows = fc._moments(series_df(spark, y), ["k"], "InvoiceDate", "Quantity").collect()
    assert np.isclose([r.kpss for r in rows if r.d == 0][0], want)


def test_order_search_finds_ar_orders(spark):
    series = {f"{p}-{i}": ar_series(phi, 800, 10 * p + i) for p, phi in ((1, [0.7]), (2, [0.3, 0.5])) for i in range(6)}
    best = {r.k: r for r in fc.fit_arima(many(spark, series), ["k"]).collect()}
    assert len(best) == len(series)
    assert sum(r.non_seasonal_p == int(k[0]) for k, r in best.items()) >= 6
    assert all(r.non_seasonal_p >= int(k[0]) for k, r in best.items() if r.non_seasonal_d == 0)


def test_white_noise_mostly_gets_order_zero_whatever_the_unit(spark):
    rng = np.random.default_rng(5)
    noise = {f"{i:02d}": rng.normal(0, 5, 365) for i in range(30)}
    found = []
    for unit in (1, 0.001, 1000):
        rows = fc.fit_arima(many(spark, {k: unit * v for k, v in noise.items()}), ["k"]).collect()
        found.append({r.k: (r.non_seasonal_p, r.non_seasonal_d) for r in rows})
    assert found[0] == found[1] == found[2] and len(found[0]) == 30
    assert sum(p == 0 for p, _ in found[0].values()) > 15


def test_short_and_constant_series_are_kept(spark):
    df = many(spark, {"one": [4], "two": [4, 6], "three": [4, 6, 5], "same": [7] * 40, "long": ar_series([0.5], 60, 2)})
    m = fc.fit_arima(df, ["k"])
    rows = {r.k: r for r in m.collect()}
    assert set(rows) == {"one", "two", "three", "same", "long"}
    assert (rows["one"].non_seasonal_p, rows["one"].AIC, rows["same"].AIC) == (0, None, None)
    out = fc.forecast(df, m, ["k"], horizon=4).collect()
    assert len(out) == 20 and all(r.forecast_value is not None and r.standard_error >= 0 for r in out)
    assert {r.forecast_value for r in out if r.k in ("one", "same")} == {4.0, 7.0}
    ex = fc.explain_forecast(df, m, ["k"], horizon=2).groupBy("k", "time_series_type").count().collect()
    assert {(r.k, r.time_series_type): r["count"] for r in ex if r.k == "two"} == {
        ("two", "history"): 2, ("two", "forecast"): 2}


def test_linear_trend_d1_drift(spark):
    y = 5.0 + 2.0 * np.arange(200) + np.random.default_rng(2).normal(0, 0.01, 200)
    df = series_df(spark, y)
    m = fc.fit_arima(df, ["k"])
    assert m.first()["non_seasonal_d"] == 1 and m.first()["has_drift"]
    out = fc.forecast(df, m, ["k"], horizon=10).orderBy("forecast_timestamp").toPandas()
    expect = 5.0 + 2.0 * np.arange(200, 210)
    assert np.abs(out["forecast_value"].to_numpy() - expect).max() < 0.5
    assert str(out["forecast_timestamp"].iloc[0]) == "2020-07-19"


def plain_forecast(y, d, phi, mean, var, h, theta=(), shocks=()):
    """The recursion written out: differences, AR and MA steps, sums; psi weights."""
    x = list(np.diff(y, n=d))
    z, e = [v - mean for v in x], list(shocks)[::-1]
    for _ in range(h):
        z.append(sum(c * z[-1 - i] for i, c in enumerate(phi) if i < len(z))
                 + sum(c * e[-1 - i] for i, c in enumerate(theta) if i < len(e)))
        e.append(0.0)
    steps, psi = [v + mean for v in z[-h:]], [1.0]
    for j in range(1, h):
        psi.append(sum(c * psi[-1 - i] for i, c in enumerate(phi) if i < len(psi))
                   + (theta[j - 1] if j <= len(theta) else 0.0))
    levels = [np.asarray(y, dtype=float)]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    for level in reversed(levels[:-1]) if d else []:
        steps = list(level[-1] + np.cumsum(steps))
    for _ in range(d):
        psi = np.cumsum(psi)
    return steps, np.sqrt(var * np.cumsum(np.square(psi)))


@pytest.mark.parametrize("d", [0, 1, 2])
def test_forecast_steps_against_plain_recursion(spark, d):
    y = ar_series([0.5, -0.2], 60, 7)
    for _ in range(d):
        y = np.cumsum(y - y.mean() + 0.3)
    phi, mean = [0.4, -0.3, 0.2], 0.25
    model = spark.createDataFrame([("s", d, phi, mean, 2.5)], "k string, non_seasonal_d int, "
                                  "ar_coefficients array<double>, intercept_or_drift double, variance double")
    out = fc.forecast(series_df(spark, y), model, ["k"], horizon=8).orderBy("forecast_timestamp").toPandas()
    steps, se = plain_forecast(y, d, phi, mean, 2.5, 8)
    assert np.allclose(out["forecast_value"], steps) and np.allclose(out["standard_error"], se)


@pytest.mark.parametrize("d", [0, 1, 2])
def test_moving_average_forecast_against_plain_recursion(spark, d):
    y = ma_series([0.5], 60, 7, c=0.0)
    for _ in range(d):
        y = np.cumsum(y + 0.3)
    phi, theta, shocks, mean = [0.4], [0.5, -0.2], [1.5, -0.7], 0.25
    model = spark.createDataFrame([("s", d, phi, theta, shocks, mean, 2.5)], "k string, non_seasonal_d int, "
                                  "ar_coefficients array<double>, ma_coefficients array<double>, "
                                  "last_shocks array<double>, intercept_or_drift double, variance double")
    out = fc.forecast(series_df(spark, y), model, ["k"], horizon=8).orderBy("forecast_timestamp").toPandas()
    steps, se = plain_forecast(y, d, phi, mean, 2.5, 8, theta, shocks)
    assert np.allclose(out["forecast_value"], steps) and np.allclose(out["standard_error"], se)


def plain_line(x, half, stride=1):
    """Tricube-weighted line through the neighbours, by numpy's least squares."""
    out = np.empty(len(x))
    for t in range(len(x)):
        at = [t + j * stride for j in range(-half, half + 1) if 0 <= t + j * stride < len(x)]
        u = np.array([(s - t) / stride for s in at])
        w = (1 - (np.abs(u) / (half + 1)) ** 3) ** 3
        if len(at) == 1:
            out[t] = x[t]
            continue
        a = np.column_stack([np.ones(len(u)), u]) * np.sqrt(w)[:, None]
        out[t] = np.linalg.lstsq(a, np.asarray([x[s] for s in at]) * np.sqrt(w), rcond=None)[0][0]
    return out


def plain_seasonal_trend(y, period):
    n, h = len(y), period // 2
    weights = np.ones(2 * h + 1)
    if period % 2 == 0:
        weights[[0, -1]] = 0.5
    trend = np.zeros(n)
    for _ in range(2):
        c = plain_line(y - trend, 3, period)
        seasonal = np.zeros(n)
        if n >= 2 * h + 1:
            means = {t: (weights * c[t - h:t + h + 1]).sum() / period for t in range(h, n - h)}
            seasonal = np.array([c[t] - means[min(max(t, h), n - h - 1)] for t in range(n)])
        trend = plain_line(y - seasonal, period)
    return trend, seasonal


@pytest.mark.parametrize("period,n", [(7, 90), (4, 40), (7, 9), (7, 5), (7, 1), (7, 2)])
def test_seasonal_trend_against_plain_implementation(spark, period, n):
    rng = np.random.default_rng(n)
    t = np.arange(n)
    y = 50 + 0.3 * t + 8 * np.sin(2 * np.pi * t / period) * (1 + t / 200) + rng.normal(0, 2, n)
    got = fc.seasonal_trend(series_df(spark, y), ["k"], period=period).orderBy("InvoiceDate").toPandas()
    trend, seasonal = plain_seasonal_trend(y, period)
    assert np.allclose(got["trend"], trend, atol=1e-8) and np.allclose(got["seasonal"], seasonal, atol=1e-8)
    assert np.allclose(got["trend"] + got["seasonal"] + got["residual"], y)


WEEK = np.array([0.0, 10.0, 20.0, 30.0, 5.0, -25.0, -40.0])


def test_weekly_series_is_forecast_with_its_week(spark):
    rng = np.random.default_rng(11)
    truth = {k: 100 + np.tile(WEEK, 60)[:400 + 14] + rng.normal(0, 2, 414) for k in ("a", "b")}
    df = many(spark, {k: v[:400] for k, v in truth.items()})
    parts = fc.seasonal_trend(df, ["k"], period=7)
    model = fc.fit_arima(fc.adjusted(parts, ["k"]), ["k"])
    out = fc.forecast(parts, model, ["k"], horizon=14).orderBy("k", "forecast_timestamp").toPandas()
    for k, y in truth.items():
        mine = out[out.k == k]
        assert np.abs(mine["forecast_value"].to_numpy() - (100 + np.tile(WEEK, 60)[400:414])).max() < 6
        inside = (mine["prediction_interval_lower_bound"].to_numpy() <= y[400:]) & (
            y[400:] <= mine["prediction_interval_upper_bound"].to_numpy())
        assert inside.sum() >= 8
    # Without the season the interval has to span the week.
    flat = fc.forecast(df, fc.fit_arima(df, ["k"]), ["k"], horizon=14)
    assert flat.agg({"standard_error": "avg"}).first()[0] > 2 * out["standard_error"].mean()


def test_parts_of_history_and_forecast_sum_to_the_value(spark):
    rng = np.random.default_rng(12)
    df = many(spark, {"level": 100 + np.tile(WEEK, 30) + rng.normal(0, 3, 210),
                      "trend": np.cumsum(rng.normal(0.5, 1, 210)) + np.tile(WEEK, 30),
                      "bent": np.cumsum(np.cumsum(rng.normal(0, 1, 120))), "short": [3.0, 5.0, 4.0], "one": [2.0]})
    parts = fc.seasonal_trend(df, ["k"], period=7)
    model = fc.fit_arima(fc.adjusted(parts, ["k"]), ["k"])
    ex = fc.explain_forecast(parts, model, ["k"], horizon=20).toPandas()
    assert not ex[["trend", "seasonal", "residual", "time_series_data"]].isna().any().any()
    total = ex["trend"] + ex["seasonal"] + ex["residual"]
    assert np.allclose(total, ex["time_series_data"], rtol=1e-9, atol=1e-7)
    assert ex.groupby(["k", "time_series_type"]).size()["level", "forecast"] == 20
    week = ex[(ex.k == "level") & (ex.time_series_type == "forecast")].sort_values("time_series_timestamp")["seasonal"]
    assert np.allclose(week.to_numpy()[:7], week.to_numpy()[7:14]) and week.max() - week.min() > 50


def test_interval_width_grows_and_covers(spark):
    horizon, hits, total = 10, 0, 0
    series = {f"{i:02d}": ar_series([0.5], 510, 100 + i, c=50.0) for i in range(40)}
    df = many(spark, {k: v[:500] for k, v in series.items()})
    out = fc.forecast(df, fc.fit_arima(df, ["k"]), ["k"], horizon=horizon, level=0.8)
    rows = out.orderBy("k", "forecast_timestamp").collect()
    for k, y in series.items():
        mine = [r for r in rows if r.k == k]
        width = [r.prediction_interval_upper_bound - r.prediction_interval_lower_bound for r in mine]
        assert np.all(np.diff(width) >= -1e-9) and all(r.confidence_level == 0.8 for r in mine)
        hits += sum(r.prediction_interval_lower_bound <= v <= r.prediction_interval_upper_bound
                    for r, v in zip(mine, y[500:]))
        total += horizon
    assert 0.7 <= hits / total <= 0.9


def test_no_python_in_the_forecast_plans(spark):
    df = series_df(spark, ar_series([0.4], 50, 5))
    m = fc.fit_arima(df, ["k"])
    for plan in (m, fc.forecast(df, m, ["k"]), fc.explain_forecast(df, m, ["k"])):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_fill_calendar_and_decompose(spark):
    rows = [("s", dt.date(2020, 1, 1), 1.0), ("s", dt.date(2020, 1, 4), 4.0),
            ("t", dt.date(2020, 1, 1), 7.0)]
    df = spark.createDataFrame(rows, "k string, InvoiceDate date, Quantity double")
    out = {(r.k, str(r.InvoiceDate)): (r.Quantity, r.filled)
           for r in fc.fill_calendar(df, ["k"]).collect()}
    assert out[("s", "2020-01-02")] == (2.0, True) and out[("s", "2020-01-03")] == (3.0, True)
    assert out[("t", "2020-01-01")] == (7.0, False) and len(out) == 5
    zero = {str(r.InvoiceDate): r.Quantity for r in fc.fill_calendar(df, ["k"], how="zero").collect()
            if r.k == "s"}
    assert zero["2020-01-02"] == 0.0
    vals = 10 + np.tile([0, 1, 2, 3, -3, -2, -1], 6).astype(float)
    d = fc.decompose(series_df(spark, vals), ["k"], period=7).orderBy("InvoiceDate").toPandas()
    inner = d.dropna(subset=["trend"])
    assert np.allclose(inner["trend"], 10.0)
    assert np.allclose(inner["residual"], 0.0, atol=1e-9)


def test_explain_has_history_and_forecast(spark):
    df = series_df(spark, ar_series([0.4], 120, 5))
    m = fc.fit_arima(df, ["k"])
    ex = fc.explain_forecast(df, m, ["k"], horizon=30).groupBy("time_series_type").count()
    got = {r[0]: r[1] for r in ex.collect()}
    assert got == {"history": 120, "forecast": 30}


def brute_decompose(dates, y, period):
    """Classical additive decomposition, written directly from its definition."""
    n, m = len(y), period
    h = m // 2
    trend = np.full(n, np.nan)
    for t in range(h, n - h):
        w = y[t - h:t + h + 1].copy()
        if m % 2 == 0:                       # 2xm average: half weights at both ends
            w[0] *= 0.5
            w[-1] *= 0.5
        trend[t] = w.sum() / m
    phase = np.array([(d - dt.date(1970, 1, 1)).days % m for d in dates])
    det = y - trend
    means = {p: np.nanmean(det[phase == p]) if np.any(~np.isnan(det[phase == p])) else np.nan
             for p in set(phase)}
    centre = np.mean([v for v in means.values()])
    seasonal = np.array([means[p] - centre for p in phase])
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("period", [4, 7, 12])
def test_decompose_matches_definition(spark, period):
    rng = np.random.default_rng(period)
    y = np.round(rng.normal(50, 10, 60) + np.tile(np.arange(period), 60)[:60], 3)
    start = dt.date(2021, 3, 5)
    keep = [i for i in range(60) if i % 9 != 4]          # gaps, filled linearly first
    df = spark.createDataFrame([("s", start + dt.timedelta(days=i), float(y[i])) for i in keep],
                               "k string, InvoiceDate date, Quantity double")
    filled = fc.fill_calendar(df, ["k"]).orderBy("InvoiceDate").toPandas()
    yf = y.copy()
    for i in range(60):
        if i not in keep:
            yf[i] = (y[i - 1] + y[i + 1]) / 2.0
    assert np.allclose(filled["Quantity"].to_numpy(), yf)
    got = fc.decompose(fc.fill_calendar(df, ["k"]), ["k"], period=period) \
            .orderBy("InvoiceDate").toPandas()
    dates = [start + dt.timedelta(days=i) for i in range(60)]
    trend, seasonal, resid = brute_decompose(dates, yf, period)
    for col, want in [("trend", trend), ("seasonal", seasonal), ("residual", resid)]:
        have = got[col].to_numpy(dtype=float)
        assert np.allclose(have, want, equal_nan=True, atol=1e-9), col
