"""Daily demand forecasting for many series at once.

All of it is Spark expressions: daily totals (T1), a gapless calendar per
series (T2), two decompositions (T3; the classical one, and seasonal-trend by
local regression), and ARIMA models (T4-T7). Window lags and one grouped
aggregate give each series' autocovariances; the KPSS test, the Levinson-Durbin
recursion, the AIC and the forecast steps are columns of one row per series.
Moving-average terms come from ``arma``.

The candidates are ARIMA(p, d, q), p up to 5, d and q up to 2, with a mean
(d = 0) or drift (d = 1). A season is taken off first (``seasonal_trend``,
``adjusted``) and its last period added to the forecast again.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import arma

DATE, VALUE = "InvoiceDate", "Quantity"
MAX_ORDER = arma.MAX_P
#: Lags of the KPSS test's long-run variance: a week, for series of any length.
KPSS_LAGS = 7


# ---- T2: gapless calendar --------------------------------------------------
def fill_calendar(df: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE,
                  how: str = "linear") -> DataFrame:
    """One row per day between each series' first and last day. Missing days
    get ``how``: 'linear' interpolation between neighbours, 'zero', or
    'previous'. Adds ``filled`` (true for inserted days)."""
    keys = list(keys)
    span = df.groupBy(*keys).agg(F.min(date_col).alias("__lo"), F.max(date_col).alias("__hi"))
    days = span.select(*keys, F.explode(F.sequence("__lo", "__hi")).alias(date_col))
    j = days.join(df.select(*keys, date_col, F.col(value_col).cast("double").alias("__y")),
                  [*keys, date_col], "left")
    if how == "zero":
        y = F.coalesce("__y", F.lit(0.0))
    else:
        known = F.when(F.col("__y").isNotNull(), F.struct(F.col(date_col).alias("d"),
                                                          F.col("__y").alias("y")))
        w = Window.partitionBy(*keys).orderBy(date_col)
        prev = F.last(known, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        # The next known day: a running last from the other end (a frame that
        # starts at the current row would rescan the rest for every row).
        back = Window.partitionBy(*keys).orderBy(F.desc(date_col))
        nxt = F.last(known, ignorenulls=True).over(
            back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        j = j.withColumn("__p", prev).withColumn("__n", nxt)
        if how == "previous":
            y = F.col("__p.y")
        elif how == "linear":
            gap = F.datediff(F.col("__n.d"), F.col("__p.d")).cast("double")
            off = F.datediff(F.col(date_col), F.col("__p.d")).cast("double")
            y = F.when(F.col("__y").isNotNull(), F.col("__y")).otherwise(
                F.col("__p.y") + (F.col("__n.y") - F.col("__p.y")) * off / gap)
        else:
            raise ValueError(f"unknown fill {how!r}")
    return j.select(*keys, date_col, y.alias(value_col), F.col("__y").isNull().alias("filled"))


# ---- T3: decomposition -----------------------------------------------------
def decompose(df: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE,
              period: int | None = None, window: int = 7) -> DataFrame:
    """Classical additive decomposition on a gapless daily series.

    trend: centred moving average over ``period`` (or ``window`` without a
    period); an even length uses the 2xm average (half weights at both ends).
    Defined only where the whole window lies inside the series.
    seasonal (with ``period``): mean detrended value per phase
    (days since 1970-01-01 mod period), centred to sum to zero; else 0.
    residual = value - trend - seasonal.
    """
    keys = list(keys)
    m = period or window
    h = m // 2
    w = Window.partitionBy(*keys).orderBy(date_col)
    y = F.col(value_col).cast("double")
    full = F.count(y).over(w.rowsBetween(-h, h)) == (2 * h + 1)
    s = F.sum(y).over(w.rowsBetween(-h, h))
    if m % 2 == 1:
        ma = s / F.lit(float(m))
    else:
        ends = F.lag(y, h).over(w) + F.lead(y, h).over(w)
        ma = (s - F.lit(0.5) * ends) / F.lit(float(m))
    out = df.select(*keys, date_col, y.alias(value_col),
                    F.when(full, ma).alias("trend"))
    if period:
        out = out.withColumn("phase", F.pmod(F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date")),
                                             F.lit(period)))
        ph = (out.groupBy(*keys, "phase").agg(F.avg(F.col(value_col) - F.col("trend")).alias("__s")))
        ph = ph.withColumn("seasonal", F.col("__s") - F.avg("__s").over(Window.partitionBy(*keys)))
        out = out.join(ph.select(*keys, "phase", "seasonal"), [*keys, "phase"], "left").drop("phase")
    else:
        out = out.withColumn("seasonal", F.lit(0.0))
    return out.select(*keys, date_col, value_col, "trend", "seasonal",
                      (F.col(value_col) - F.col("trend") - F.col("seasonal")).alias("residual"))


def _tricube(half: int) -> dict[int, float]:
    """Weight by distance in steps, to ``half`` on either side."""
    return {j: (1 - (abs(j) / (half + 1)) ** 3) ** 3 for j in range(-half, half + 1)}


def _local_line(df: DataFrame, source: str, out: str, w, half: int, stride: int = 1) -> DataFrame:
    """Adds ``out``: at each row the value there of the line fitted to the rows
    up to ``half`` steps of ``stride`` away, with tricube weights. At the ends
    the window has one side; a single row is its own value."""
    weight = _tricube(half)
    lag = {j: f"__lag{j + half}" for j in weight}
    df = df.withColumns({lag[j]: F.lag(source, j * stride).over(w) for j in weight})

    def total(power: int, value: str) -> Column:
        # Rows j steps back lie at -j. Written as SQL text: there are many terms.
        return F.expr(" + ".join(f"CASE WHEN {lag[j]} IS NOT NULL THEN ({weight[j] * (-j) ** power!r}D) * {value.format(lag[j])} "
                                 "ELSE 0D END" for j in weight))

    zero = F.lit(0.0)
    df = df.withColumns({"__s0": total(0, "1D"), "__s1": total(1, "1D"), "__s2": total(2, "1D"),
                         "__y0": total(0, "{}"), "__y1": total(1, "{}")})
    det = F.col("__s0") * F.col("__s2") - F.col("__s1") * F.col("__s1")
    line = (F.col("__y0") * F.col("__s2") - F.col("__y1") * F.col("__s1")) / F.nullif(det, zero)
    value = F.when(det > 1e-9, line).otherwise(F.col("__y0") / F.col("__s0"))
    return df.withColumn(out, value).drop(*lag.values(), "__s0", "__s1", "__s2", "__y0", "__y1")


def seasonal_trend(df: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE, period: int = 7,
                   season_half: int = 3, trend_half: int | None = None, loops: int = 2) -> DataFrame:
    """T3 with a season that may change: seasonal-trend decomposition of a
    gapless daily series by local regression.

    Each of the inner loops takes the trend off, smooths every phase of the
    period along the periods (``season_half`` on either side), takes a whole
    period's mean of the result off (at the ends the nearest one inside), so
    that the season sums to about zero, and smooths the adjusted series
    (``trend_half`` days on either side, the period by default) to the next
    trend. All three parts exist on every day and add up to the value; a
    series shorter than a period has no season. One exchange: all windows are
    by series in date order, and a phase's neighbours are lags of whole
    periods."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(date_col)
    h = period // 2
    out = df.select(*keys, date_col, F.col(value_col).cast("double").alias(value_col)).withColumn("trend", F.lit(0.0))
    for _ in range(loops):
        out = out.withColumn("__x", F.col(value_col) - F.col("trend"))
        out = _local_line(out, "__x", "__c", w, season_half, period)
        around = w.rowsBetween(-h, h)
        mean = F.sum("__c").over(around)
        if period % 2 == 0:  # half weights at both ends
            mean = mean - F.lit(0.5) * (F.lag("__c", h).over(w) + F.lead("__c", h).over(w))
        out = out.withColumn("__m", F.when(F.count("__c").over(around) == 2 * h + 1, mean / F.lit(float(period))))
        near = F.coalesce("__m", *[F.lead("__m", k).over(w) for k in range(1, h + 1)],
                          *[F.lag("__m", k).over(w) for k in range(1, h + 1)])
        out = out.withColumn("seasonal", F.coalesce(F.col("__c") - near, F.lit(0.0)))
        out = out.withColumn("__x", F.col(value_col) - F.col("seasonal"))
        out = _local_line(out, "__x", "trend", w, trend_half or period)
    return out.select(*keys, date_col, value_col, "trend", "seasonal",
                      (F.col(value_col) - F.col("trend") - F.col("seasonal")).alias("residual"))


def adjusted(parts: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE) -> DataFrame:
    """The series without the season that ``seasonal_trend`` found."""
    return parts.select(*keys, date_col, (F.col(value_col) - F.col("seasonal")).alias(value_col))


# ---- T4/T5: moments, differencing order, candidates -------------------------
# Fixed value: 5% critical value of the KPSS level-stationarity statistic.
KPSS_CRITICAL_5PCT = 0.463


def _moments(series: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """Per series and differencing order d = 0, 1, 2: number of points, mean,
    autocovariances r0..r{KPSS_LAGS} (divided by n, so the Yule-Walker model is
    always stationary) and the KPSS statistic. One row per series and d, from
    windows over the daily rows and one aggregate. For d = 2 the mean is 0."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    y = F.col(value_col).cast("double")
    step = series.select(*keys, F.col(date_col).alias("__t"), y.alias("__0"), (y - F.lag(y).over(w)).alias("__1"))
    w = Window.partitionBy(*keys).orderBy("__t")
    step = step.withColumn("__2", F.col("__1") - F.lag("__1").over(w))
    long = step.select(*keys, "__t", F.explode(F.array(*[
        F.struct(F.lit(d).alias("d"), F.col(f"__{d}").alias("x")) for d in range(3)])).alias("__s")).select(
        *keys, "__t", "__s.d", "__s.x").where("x IS NOT NULL OR d = 0")
    group = Window.partitionBy(*keys, "d")
    mean = F.when(F.col("d") < 2, F.avg("x").over(group)).otherwise(F.lit(0.0))
    long = long.withColumn("mean", mean).withColumn("z", F.col("x") - F.col("mean"))
    w = group.orderBy("__t")
    lags = [F.coalesce(F.col("z") * F.lag("z", k).over(w), F.lit(0.0)).alias(f"__p{k}") for k in range(KPSS_LAGS + 1)]
    run = F.sum("z").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = long.select(*keys, "d", "mean", run.alias("__c"), *lags)
    m = rows.groupBy(*keys, "d").agg(
        F.count("*").alias("n"), F.max("mean").alias("mean"), F.sum(F.col("__c") * F.col("__c")).alias("__cc"),
        *[(F.sum(f"__p{k}") / F.count("*")).alias(f"r{k}") for k in range(KPSS_LAGS + 1)])
    long_run = F.col("r0") + sum(F.col(f"r{k}") * (2 * (1 - k / (KPSS_LAGS + 1))) for k in range(1, KPSS_LAGS + 1))
    n = F.col("n").cast("double")
    # A series without variance is stationary; the Bartlett weights keep long_run >= 0.
    return m.withColumn("kpss", F.when(long_run > 1e-12 * F.col("r0"), F.col("__cc") / (n * n * long_run))
                        .otherwise(F.lit(0.0))).drop("__cc")


def _differenced(series: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """The moments row of each series at its own d: the least d whose
    differences are not found non-stationary, 2 at most."""
    m = _moments(series, keys, date_col, value_col)
    ok = (F.col("kpss") <= KPSS_CRITICAL_5PCT) | (F.col("d") == 2)
    fields = F.struct("d", "n", "mean", *[f"r{k}" for k in range(KPSS_LAGS + 1)])
    return m.where(ok).groupBy(*keys).agg(F.min_by(fields, F.col("d")).alias("__m")).select(*keys, "__m.*")


def _levinson(m: DataFrame, orders: int) -> tuple[DataFrame, list[list[Column]]]:
    """Adds the variances ``v0`` to ``v{orders}`` of the autoregressions of the
    autocovariances ``r0``, ``r1``, ...; and each order's coefficients."""
    zero = F.lit(0.0)
    m, a, found = m.withColumn("v0", F.col("r0")), [], [[]]
    for p in range(1, orders + 1):
        inner = F.col(f"r{p}") - sum((a[i] * F.col(f"r{p - 1 - i}") for i in range(p - 1)), zero)
        m = m.withColumn(f"k{p}", F.when(F.col(f"v{p - 1}") > 0, inner / F.col(f"v{p - 1}")).otherwise(zero))
        k = F.col(f"k{p}")
        m = m.withColumns({**{f"a{p}_{i}": a[i] - k * a[p - 2 - i] for i in range(p - 1)},
                           f"v{p}": F.greatest(zero, F.col(f"v{p - 1}") * (1 - k * k))})
        a = [F.col(f"a{p}_{i}") for i in range(p - 1)] + [k]
        found.append(a)
    return m, found


def _shock_rows(series: DataFrame, m: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """The daily rows at their series' own differencing order, less the mean
    (``z``), with the long autoregression's coefficients."""
    w = Window.partitionBy(*keys).orderBy("__t")
    step = series.select(*keys, F.col(date_col).alias("__t"), F.col(value_col).cast("double").alias("__0"))
    step = step.withColumn("__1", F.col("__0") - F.lag("__0").over(w))
    step = step.withColumn("__2", F.col("__1") - F.lag("__1").over(w))
    x = F.when(F.col("d") == 0, F.col("__0")).when(F.col("d") == 1, F.col("__1")).otherwise(F.col("__2"))
    return (step.join(m, keys).withColumn("z", x - F.col("mean")).filter("z IS NOT NULL")
            .select(*keys, "__t", "z", *[f"long{k}" for k in range(1, KPSS_LAGS + 1)]))


def arima_evaluate(series: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE,
                   flags: DataFrame | None = None) -> DataFrame:
    """T5: one row per (series, orders p = 0..5 and q = 0..2) with
    log-likelihood, AIC, variance and coefficients. ``series`` must be gapless
    (``fill_calendar``).

    The orders without moving-average terms of a series come from the same
    autocovariances (Levinson-Durbin), so they are scored on one sample and
    differ by powers of the reflection coefficients only: the choice does not
    depend on the unit of the values. With such terms (``arma``), the variance
    of the same p is multiplied by the share of the squared error that the
    shocks of the days before leave, measured on one sample for all of them.
    Order (0, 0) exists for any series, however short; a series without
    variance has null log-likelihood and AIC and keeps that order. ``flags``
    (one row per series, ``anomalies.flags``) adds its columns."""
    keys = list(keys)
    own = keys
    if not keys:
        # One unnamed series: the same key in all rows, no literal, so that
        # joins on it stay equi-joins.
        own = ["__one"]
        series = series.withColumn("__one", F.datediff(date_col, date_col))
    m, coefficients = _levinson(_differenced(series, own, date_col, value_col), KPSS_LAGS)
    # One row per series each, read several times: cut off from the daily rows.
    shared_dir(series.sparkSession)
    m = m.checkpoint(eager=True)
    none = F.array().cast("array<double>")
    one = lambda p: F.struct(
        F.lit(p).alias("p"), F.lit(0).alias("q"), F.col(f"v{p}").alias("variance"),
        (F.array(*coefficients[p]) if p else none).alias("ar"), none.alias("ma"), none.alias("shocks"))
    base = m.select(*own, "d", "n", "mean", F.explode(F.array(*[one(p) for p in range(MAX_ORDER + 1)])).alias("o")).select(
        *own, "d", "n", "mean", "o.*")
    model = m.select(*own, "d", "mean", *[a.alias(f"long{k}") for k, a in enumerate(coefficients[KPSS_LAGS], 1)])
    moments = arma.lagged_moments(_shock_rows(series, model, own, date_col, value_col), own, "__t", KPSS_LAGS)
    moved = arma.candidates(moments.checkpoint(eager=True), own)
    share = moved.join(base.select(*own, "d", "n", "mean", "p", F.col("variance").alias("plain")), [*own, "p"])
    rows = base.unionByName(share.select(
        *own, "d", "n", "mean", "p", "q", (F.col("plain") * F.col("gain")).alias("variance"), "ar", "ma",
        F.col("last_shocks").alias("shocks")))
    n = F.col("n").cast("double")
    ll = F.when(F.col("variance") > 0, -n / 2 * (F.log(2 * math.pi * F.col("variance")) + 1))
    params = F.col("p") + F.col("q") + 1 + F.when(F.col("d") < 2, 1).otherwise(0)
    if flags is not None:
        if not keys:
            raise ValueError("flags need the keys of several series")
        rows = rows.join(flags, keys)
    own_flags = [] if flags is None else [c for c in flags.columns if c not in keys]
    return rows.select(
        *keys, F.col("p").alias("non_seasonal_p"), F.col("d").alias("non_seasonal_d"), F.col("q").alias("non_seasonal_q"),
        (F.col("d") == 1).alias("has_drift"), ll.alias("log_likelihood"), (2 * params - 2 * ll).alias("AIC"),
        "variance", F.col("ar").alias("ar_coefficients"), F.col("ma").alias("ma_coefficients"),
        F.col("shocks").alias("last_shocks"), F.col("mean").alias("intercept_or_drift"),
        F.col("n").cast("int").alias("n_points"), *own_flags)


def fit_arima(series: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE) -> DataFrame:
    """T4: the lowest-AIC orders per series, the fewer terms on ties, then the
    smaller q: exactly one row per series."""
    keys = list(keys)
    cands = arima_evaluate(series, keys, date_col, value_col)
    # Without variance every AIC is null and order 0 stays.
    score = F.coalesce(F.round("AIC", 8), F.lit(0.0))
    best = cands.groupBy(*keys).agg(
        F.min_by(F.struct(*[c for c in cands.columns if c not in keys]),
                 F.struct(score, F.col("non_seasonal_p") + F.col("non_seasonal_q"), "non_seasonal_q")).alias("m"))
    return best.select(*keys, "m.*")


# ---- T6/T7: forecast and explain ---------------------------------------------
def _steps(series: DataFrame, model: DataFrame, keys: list[str], date_col: str, value_col: str, horizon: int,
           period: int) -> DataFrame:
    """(keys, last, f.h, f.value, f.trend, f.se, season): the steps ahead, the
    trend part of each (mean, drift or slope) and the season of its day."""
    tail = max(MAX_ORDER + 2, period)
    w = Window.partitionBy(*keys).orderBy(F.desc(date_col))
    season = F.col("seasonal") if "seasonal" in series.columns else F.lit(0.0)
    last = (series.select(*keys, date_col, F.col(value_col).cast("double").alias("y"), season.alias("s"))
            .withColumn("__i", F.row_number().over(w)).where(F.col("__i") <= tail)
            .groupBy(*keys).agg(F.max(date_col).alias("last"),
                                F.sort_array(F.collect_list(F.struct("__i", "y", "s"))).alias("__r"))
            .select(*keys, "last", F.transform("__r", lambda r: r["y"] - r["s"]).alias("y"),
                    F.transform("__r", lambda r: r["s"]).alias("s")))
    none = F.array().cast("array<double>")
    extra = [F.col(c) if c in model.columns else none.alias(c) for c in ("ma_coefficients", "last_shocks")]
    model = model.select(*keys, "non_seasonal_d", "ar_coefficients", "intercept_or_drift", "variance", *extra)
    if keys:
        row = last.join(model, keys)
    else:  # one unnamed series: a row on either side, put together without a join
        both = last.unionByName(model, allowMissingColumns=True)
        row = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    zero = F.lit(0.0)
    at = lambda arr, i: F.coalesce(F.get(arr, F.lit(i)), zero)
    y, d, mean = F.col("y"), F.col("non_seasonal_d"), F.col("intercept_or_drift")
    diff1 = [F.get(y, F.lit(i)) - F.get(y, F.lit(i + 1)) for i in range(MAX_ORDER + 1)]
    z = [F.coalesce(F.when(d == 0, F.get(y, F.lit(i))).when(d == 1, diff1[i]).otherwise(diff1[i] - diff1[i + 1]) - mean,
                    zero) for i in range(MAX_ORDER)]
    phi = [at(F.col("ar_coefficients"), i) for i in range(MAX_ORDER)]
    theta = [at(F.col("ma_coefficients"), i) for i in range(arma.MAX_Q)]
    row = row.select(*keys, "last", d.alias("d"), mean.alias("mean"), "variance", "s", F.array(*z).alias("z"),
                     F.array(*phi).alias("phi"), F.array(*theta).alias("theta"),
                     F.array(*[at(F.col("last_shocks"), i) for i in range(arma.MAX_Q)]).alias("e"),
                     F.get(y, F.lit(0)).alias("y0"), F.coalesce(diff1[0], zero).alias("s0"))
    dot = lambda a, b, n: sum((F.get(a, F.lit(i)) * F.get(b, F.lit(i)) for i in range(n)), zero)

    def step(acc, h):
        # Shocks to come are 0; those of the last days still count.
        z1 = dot(acc["z"], F.col("phi"), MAX_ORDER) + dot(acc["e"], F.col("theta"), arma.MAX_Q)
        # The part that comes from z, integrated d times: beside mean, drift or slope.
        bend = acc["bend"] + z1
        moved = F.when(F.col("d") == 0, z1).when(F.col("d") == 1, acc["moved"] + z1).otherwise(acc["moved"] + bend)
        trend = (F.when(F.col("d") == 0, F.col("mean")).when(F.col("d") == 1, F.col("y0") + h * F.col("mean"))
                 .otherwise(F.col("y0") + h * F.col("s0") + h * (h + 1) / 2 * F.col("mean")))
        # psi: weights of a shock j days old; integrated d times.
        psi0 = F.when(h == 1, F.lit(1.0)).otherwise(
            dot(acc["psi"], F.col("phi"), MAX_ORDER) + F.coalesce(F.get(F.col("theta"), h - 2), zero))
        psi1 = acc["psi1"] + psi0
        psi2 = acc["psi2"] + psi1
        weight = F.when(F.col("d") == 0, psi0).when(F.col("d") == 1, psi1).otherwise(psi2)
        total = acc["total"] + weight * weight
        out = F.struct(h.alias("h"), (trend + moved).alias("value"), trend.alias("trend"),
                       F.sqrt(F.col("variance") * total).alias("se"))
        shift = lambda new, old, n: F.concat(F.array(new), F.slice(old, 1, n - 1))
        return F.struct(shift(z1, acc["z"], MAX_ORDER).alias("z"), shift(zero, acc["e"], arma.MAX_Q).alias("e"),
                        shift(psi0, acc["psi"], MAX_ORDER).alias("psi"), bend.alias("bend"), moved.alias("moved"),
                        psi1.alias("psi1"), psi2.alias("psi2"), total.alias("total"),
                        F.concat(acc["out"], F.array(out)).alias("out"))

    start = F.struct(F.col("z"), F.col("e"), F.array(*[zero] * MAX_ORDER).alias("psi"), zero.alias("bend"),
                     zero.alias("moved"), zero.alias("psi1"), zero.alias("psi2"), zero.alias("total"),
                     F.array().cast("array<struct<h:int,value:double,trend:double,se:double>>").alias("out"))
    steps = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda acc: acc["out"])
    rows = row.select(*keys, "last", "s", F.explode(steps).alias("f"))
    # The day of the same phase in the last period.
    phase = F.pmod(F.lit(period) - F.col("f.h"), F.lit(period))
    return rows.select(*keys, "last", "f", F.coalesce(F.get("s", phase), zero).alias("season"))


def _bounds(value: Column, se: Column, level: float) -> list[Column]:
    q = NormalDist().inv_cdf(0.5 + level / 2.0)
    return [se.alias("standard_error"), F.lit(level).alias("confidence_level"),
            (value - q * se).alias("prediction_interval_lower_bound"),
            (value + q * se).alias("prediction_interval_upper_bound")]


def forecast(series: DataFrame, model: DataFrame, keys=(), date_col: str = DATE,
             value_col: str = VALUE, horizon: int = 10, level: float = 0.8, period: int = 7) -> DataFrame:
    """``horizon`` days ahead per series with a ``level`` prediction
    interval. ``model`` is ``fit_arima`` output (one row per series).

    ``series`` may be ``seasonal_trend`` output, with the model fitted to
    ``adjusted`` of it: then the last ``period``'s season is added to each day.

    The last days of each series are the state: the last five differenced
    values less their mean, the last two shocks, the last value and the last
    difference. The steps are a fold over the horizon on that one row, so
    nothing is collected."""
    keys = list(keys)
    value = F.col("f.value") + F.col("season")
    return _steps(series, model, keys, date_col, value_col, horizon, period).select(
        *keys, F.date_add("last", F.col("f.h")).alias("forecast_timestamp"), value.alias("forecast_value"),
        *_bounds(value, F.col("f.se"), level))


def explain_forecast(series: DataFrame, model: DataFrame, keys=(), date_col: str = DATE,
                     value_col: str = VALUE, horizon: int = 30, level: float = 0.8,
                     period: int | None = None) -> DataFrame:
    """History rows with their decomposition, then forecast rows with
    intervals, in one table (``time_series_type`` = 'history' / 'forecast').

    ``series`` may be ``seasonal_trend`` output (and the model fitted to
    ``adjusted`` of it); otherwise the history is decomposed classically. The
    parts of a forecast are the trend (mean, drift or slope), the season of
    its day, and as residual what the autoregressive and moving-average terms
    add; they sum to the value."""
    keys = list(keys)
    whole = {"trend", "seasonal", "residual"} <= set(series.columns)
    parts = series if whole else decompose(series, keys, date_col, value_col, period)
    none = F.lit(None).cast("double")
    hist = parts.select(
        *keys, F.col(date_col).alias("time_series_timestamp"),
        F.lit("history").alias("time_series_type"),
        F.col(value_col).alias("time_series_data"),
        none.alias("standard_error"), none.alias("confidence_level"),
        none.alias("prediction_interval_lower_bound"), none.alias("prediction_interval_upper_bound"),
        "trend", "seasonal", "residual")
    value = F.col("f.value") + F.col("season")
    fc = _steps(series, model, keys, date_col, value_col, horizon, period or 7).select(
        *keys, F.date_add("last", F.col("f.h")).alias("time_series_timestamp"),
        F.lit("forecast").alias("time_series_type"), value.alias("time_series_data"),
        *_bounds(value, F.col("f.se"), level), F.col("f.trend").alias("trend"), F.col("season").alias("seasonal"),
        (F.col("f.value") - F.col("f.trend")).alias("residual"))
    return hist.unionByName(fc)
