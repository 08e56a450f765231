"""Moving-average terms of the automatic order search (part of T4 and T5).

Hannan and Rissanen's two steps, for all series at once. A long autoregression
gives each day's shock; the shocks of the days before are then regressors like
the lagged values. Window lags make the rows, one grouped aggregate their
moments, and elimination on one row per series solves every order: with the
lagged shocks first, the leading blocks of one matrix are the orders p = 0, 1,
2, ... of that q, so three matrices hold all candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_P, MAX_Q = 5, 2
#: Least days on which all lags exist.
LEAST_DAYS = 30
#: A pivot below this share of its variable's square sum is rounding.
TINY = 1e-9


def _variables(q: int) -> list[str]:
    return [f"e{i}" for i in range(1, q + 1)] + [f"z{i}" for i in range(1, MAX_P + 1)]


def lagged_moments(rows: DataFrame, keys: list[str], time_col: str, long_order: int) -> DataFrame:
    """Per series the sums of products of the value ``z``, its lags and the
    lagged shocks over the days on which all exist, their number, and the last
    two shocks. ``rows`` holds ``z`` and the long autoregression's
    coefficients ``long1``, ``long2``, ..."""
    w = Window.partitionBy(*keys).orderBy(time_col)
    shock = F.col("z") - sum(F.col(f"long{k}") * F.lag("z", k).over(w) for k in range(1, long_order + 1))
    rows = rows.withColumn("e0", shock)
    rows = rows.withColumns({**{f"z{k}": F.lag("z", k).over(w) for k in range(1, MAX_P + 1)},
                             **{f"e{k}": F.lag("e0", k).over(w) for k in range(1, MAX_Q + 1)}})
    names = ["z", *_variables(MAX_Q)]
    # Shocks start after the long lags, so a day with all shocks has all values.
    whole = f"e{MAX_Q} IS NOT NULL"
    sums = [F.expr(f"sum(CASE WHEN {whole} THEN {a} * {b} END) AS s_{a}_{b}")
            for i, a in enumerate(names) for b in names[i:]]
    shocks = ", ".join(f"coalesce(e{k}, 0D)" for k in range(MAX_Q))
    return rows.groupBy(*keys).agg(F.expr(f"count_if({whole}) AS days"), *sums,
                                   F.expr(f"max_by(array({shocks}), {time_col}) AS last_shocks"))


# The solver's columns are written as SQL text: there are hundreds of them.

def _with(m: DataFrame, step: dict[str, str]) -> DataFrame:
    return m.withColumns({name: F.expr(text) for name, text in step.items()}) if step else m


def _moment(a: str, b: str) -> str:
    return "s_" + "_".join(sorted((a, b), key=["z", *_variables(MAX_Q)].index))


def _eliminated(m: DataFrame) -> DataFrame:
    """Adds the rows of the reduced matrices: ``u{q}_{i}_{j}`` (j >= i) and the
    right-hand sides ``c{q}_{i}``."""
    first = {}
    for q in range(MAX_Q + 1):
        mine = _variables(q)
        for i, a in enumerate(mine):
            first[f"c{q}_{i}"] = _moment("z", a)
            first |= {f"u{q}_{i}_{j}": _moment(a, mine[j]) for j in range(i, len(mine))}
    m = _with(m, first)
    for k in range(MAX_P + MAX_Q):
        step = {}
        for q in range(MAX_Q + 1):
            for i in range(k + 1, MAX_P + q):
                factor = f"CASE WHEN u{q}_{k}_{k} > 0 THEN u{q}_{k}_{i} / u{q}_{k}_{k} ELSE 0D END"
                step[f"c{q}_{i}"] = f"c{q}_{i} - {factor} * c{q}_{k}"
                step |= {f"u{q}_{i}_{j}": f"u{q}_{i}_{j} - {factor} * u{q}_{k}_{j}" for j in range(i, MAX_P + q)}
        m = _with(m, step)
    return m


def _solved(m: DataFrame) -> DataFrame:
    """Adds the coefficients ``x{p}_{q}_{i}`` of every order with q > 0, the
    lagged shocks' first, and the remaining square sums ``sse{p}_{q}``."""
    for back in range(MAX_P + MAX_Q):
        step = {}
        for q in range(1, MAX_Q + 1):
            for p in range(MAX_P + 1):
                i = p + q - 1 - back
                if i >= 0:
                    known = "".join(f" - u{q}_{i}_{j} * x{p}_{q}_{j}" for j in range(i + 1, p + q))
                    step[f"x{p}_{q}_{i}"] = f"(c{q}_{i}{known}) / nullif(u{q}_{i}_{i}, 0D)"
        m = _with(m, step)
    gain = "coalesce(c{0}_{1} * c{0}_{1} / nullif(u{0}_{1}_{1}, 0D), 0D)"
    return _with(m, {f"sse{p}_{q}": "s_z_z" + "".join(f" - {gain.format(q, i)}" for i in range(p + q))
                     for q in range(MAX_Q + 1) for p in range(MAX_P + 1)})


def _stationary(m: DataFrame) -> DataFrame:
    """Adds ``g{p}_{q}_{i}``: the partial autocorrelations of the
    autoregressive part, from the recursion run downwards (2 once one of them
    isn't inside 1)."""
    orders = [(p, q) for q in range(1, MAX_Q + 1) for p in range(1, MAX_P + 1)]
    m = _with(m, {f"g{p}_{q}_{i}": f"x{p}_{q}_{q + i - 1}" for p, q in orders for i in range(1, p + 1)})
    for down in range(MAX_P - 1):
        step = {}
        for p, q in orders:
            top = p - down
            k = f"g{p}_{q}_{top}"
            step |= {f"g{p}_{q}_{i}": f"CASE WHEN abs({k}) < 1 THEN (g{p}_{q}_{i} + {k} * g{p}_{q}_{top - i}) "
                                      f"/ (1 - {k} * {k}) ELSE 2D END" for i in range(1, top)}
        m = _with(m, step)
    return m


def candidates(moments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, p, q, gain, ar, ma, last_shocks): the admissible orders with
    q = 1 or 2. ``gain`` is the share of the least squares error of the same p
    without shocks that is left, on the same days. Orders that aren't
    stationary and invertible, whose matrix is singular, or of series with
    fewer than ``LEAST_DAYS`` such days are left out."""
    m = _stationary(_solved(_eliminated(moments.filter(F.col("days") >= LEAST_DAYS))))
    options = []
    for q in range(1, MAX_Q + 1):
        for p in range(MAX_P + 1):
            x = [f"x{p}_{q}_{i}" for i in range(p + q)]
            # 1 + t1 B + t2 B^2 has its roots outside the unit circle.
            ok = [f"abs({x[0]}) < 1"] if q == 1 else [f"abs({x[1]}) < 1", f"{x[1]} + {x[0]} > -1", f"{x[1]} - {x[0]} > -1"]
            ok += [f"u{q}_{i}_{i} > {TINY!r}D * s_{a}_{a}" for i, a in enumerate(_variables(q)[:p + q])]
            ok += [f"abs(g{p}_{q}_{i}) < 1" for i in range(1, p + 1)]
            ok += [f"sse{p}_{q} > 0", f"sse{p}_0 > 0"]
            options.append(f"named_struct('p', {p}, 'q', {q}, 'ok', coalesce({' AND '.join(ok)}, false), "
                           f"'gain', sse{p}_{q} / nullif(sse{p}_0, 0D), "
                           f"'ar', cast(array({', '.join(x[q:])}) AS array<double>), 'ma', array({', '.join(x[:q])}))")
    rows = m.select(*keys, "last_shocks", F.expr(f"explode(array({', '.join(options)})) AS o")).filter("o.ok")
    return rows.select(*keys, "o.p", "o.q", "o.gain", "o.ar", "o.ma", "last_shocks")
