"""DuckDB SQL twins of the registered queries (the correctness oracle).

Built from shared fragments so every query reads the driver tables through
the same retail derivation as the Spark side (``fixtures.RAW_SQL``).
"""

from __future__ import annotations

from ..fixtures import RAW_SQL

# The business rules, written out here so that the oracle does
# not share constants with the code under test.
BUSINESS_SQL = """UnitPrice >= 0.04 AND Country NOT IN ('European Community', 'Unspecified')
 AND StockCode NOT IN ('POST', 'D', 'DOT', 'M', 'S', 'AMAZONFEE', 'm', 'DCGSSBOY', 'DCGSSGIRL', 'PADS', 'B', 'CRUK')
 AND CustomerID != 16446"""


def curated_where(as_of: str = "current_date") -> str:
    return (f"InvoiceDate <= {as_of} AND CustomerID IS NOT NULL AND Description IS NOT NULL AND {BUSINESS_SQL}")


def base_ctes(as_of: str = "current_date", x: str = "", with_raw: bool = True) -> str:
    """raw, {x}curated, {x}t (typed), {x}p (purchases), {x}r (returns)."""
    raw = f"raw AS ({RAW_SQL}),\n" if with_raw else ""
    return f"""{raw}{x}curated AS (SELECT * FROM raw WHERE {curated_where(as_of)}),
{x}t AS (SELECT InvoiceNo, StockCode, Quantity, InvoiceDate, UnitPrice,
             CAST(trunc(CustomerID) AS BIGINT) AS CustomerID, Country FROM {x}curated),
{x}p AS (SELECT * FROM {x}t WHERE Quantity >= 0),
{x}r AS (SELECT CustomerID, Quantity FROM {x}t WHERE Quantity < 0)"""


def feature_ctes(t: str = "t", p: str = "p", r: str = "r", prefix: str = "") -> str:
    """The five per-customer aggregates and the joined feature table
    ``{prefix}feat`` over frames t (filtered), p, r."""
    x = prefix
    return f"""{x}rev AS (SELECT CustomerID, COALESCE(SUM(Quantity * UnitPrice), 0.0) AS gross_revenue
        FROM {p} WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
{x}rec AS (SELECT CustomerID, CAST(date_diff('day', max(InvoiceDate),
             (SELECT max(InvoiceDate) FROM {t})) AS BIGINT) AS recency_days
        FROM {p} WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
{x}qp AS (SELECT CustomerID, COUNT(StockCode) AS qty_products FROM {p}
        WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
{x}fr AS (SELECT CustomerID, CAST(COUNT(InvoiceNo) AS DOUBLE)
             / CAST(date_diff('day', min(InvoiceDate), max(InvoiceDate)) + 1 AS DOUBLE) AS frequency
        FROM (SELECT DISTINCT CustomerID, InvoiceNo, InvoiceDate FROM {p} WHERE CustomerID IS NOT NULL)
        GROUP BY CustomerID),
{x}rt AS (SELECT CustomerID, CAST(-COALESCE(SUM(Quantity), 0) AS BIGINT) AS qty_returns
        FROM {r} WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
{x}feat AS (SELECT c.CustomerID, {x}rev.gross_revenue, {x}rec.recency_days, {x}qp.qty_products,
             {x}fr.frequency, COALESCE({x}rt.qty_returns, 0) AS qty_returns
        FROM (SELECT DISTINCT CustomerID FROM {t}) c
        LEFT JOIN {x}rev USING (CustomerID) LEFT JOIN {x}rec USING (CustomerID)
        LEFT JOIN {x}qp USING (CustomerID) LEFT JOIN {x}fr USING (CustomerID)
        LEFT JOIN {x}rt USING (CustomerID)
        WHERE c.CustomerID IS NOT NULL AND {x}rev.gross_revenue IS NOT NULL
          AND {x}rec.recency_days IS NOT NULL AND {x}qp.qty_products IS NOT NULL
          AND {x}fr.frequency IS NOT NULL)"""


FEATURE_SELECT = ("CustomerID, ROUND(gross_revenue, 2) AS gross_revenue, recency_days, "
                  "qty_products, frequency, qty_returns")


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}

ORACLE["curated"] = with_(base_ctes(), "SELECT * FROM curated")
ORACLE["customer_features"] = with_(base_ctes() + ",\n" + feature_ctes(),
                                    f"SELECT {FEATURE_SELECT} FROM feat")
ORACLE["features_join"] = ORACLE["customer_features"]

B = base_ctes()
TYPED8 = """SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
  CAST(trunc(CustomerID) AS BIGINT) AS CustomerID, Country FROM curated"""
ORACLE["scan_until"] = with_(B, TYPED8 + " WHERE InvoiceDate <= DATE '1998-08-02'")
ORACLE["run_sql"] = with_(B, """SELECT Country, COUNT(*) AS n_lines, CAST(SUM(Quantity) AS BIGINT) AS qty
FROM curated WHERE InvoiceDate <= CURRENT_DATE GROUP BY Country""")
ORACLE["curated_roundtrip"] = ORACLE["curated"]
ORACLE["write_modes"] = with_(B, TYPED8)
ORACLE["clean_not_null"] = with_(f"raw AS ({RAW_SQL})",
    "SELECT * FROM raw WHERE InvoiceDate <= current_date AND CustomerID IS NOT NULL AND Description IS NOT NULL")
ORACLE["clean_business"] = with_(f"raw AS ({RAW_SQL})",
    f"SELECT * FROM raw WHERE {BUSINESS_SQL}")
ORACLE["project_filtered"] = with_(B, "SELECT * FROM t")
ORACLE["split_returns"] = with_(B, "SELECT * FROM r")
ORACLE["split_purchases"] = with_(B, """SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate,
  UnitPrice, CAST(trunc(CustomerID) AS BIGINT) AS CustomerID, Country FROM curated WHERE Quantity >= 0""")
FC = B + ",\n" + feature_ctes()
ORACLE["gross_revenue"] = with_(FC, "SELECT CustomerID, ROUND(gross_revenue, 2) AS gross_revenue FROM rev")
ORACLE["recency"] = with_(FC, "SELECT * FROM rec")
ORACLE["qty_products"] = with_(FC, "SELECT * FROM qp")
ORACLE["frequency"] = with_(B, """SELECT CustomerID, max(InvoiceDate) AS max_, min(InvoiceDate) AS min_,
  CAST(date_diff('day', min(InvoiceDate), max(InvoiceDate)) + 1 AS BIGINT) AS days_,
  COUNT(InvoiceNo) AS buy_,
  CAST(COUNT(InvoiceNo) AS DOUBLE) / CAST(date_diff('day', min(InvoiceDate), max(InvoiceDate)) + 1 AS DOUBLE) AS frequency
FROM (SELECT DISTINCT CustomerID, InvoiceNo, InvoiceDate FROM p WHERE CustomerID IS NOT NULL)
GROUP BY CustomerID""")
ORACLE["qty_returns"] = with_(FC, "SELECT * FROM rt")
ORACLE["distinct_customers"] = with_(B, "SELECT DISTINCT CustomerID FROM t")
ORACLE["active_customers"] = with_(f"raw AS ({RAW_SQL})",
    "SELECT DISTINCT CustomerID FROM raw WHERE InvoiceDate = DATE '1998-07-21'")
ORACLE["daily_quantity"] = with_(B, """SELECT InvoiceDate, CAST(SUM(Quantity) AS BIGINT) AS Quantity
FROM curated WHERE InvoiceDate BETWEEN DATE '1996-01-01' AND DATE '1997-01-01' GROUP BY InvoiceDate""")
ORACLE["daily_quantity_by_country"] = with_(B, """SELECT Country, InvoiceDate, CAST(SUM(Quantity) AS BIGINT) AS Quantity
FROM curated WHERE InvoiceDate BETWEEN DATE '1996-01-01' AND DATE '1997-01-01' GROUP BY Country, InvoiceDate""")
ORACLE["cast_int"] = with_(f"raw AS ({RAW_SQL})", """SELECT InvoiceNo, StockCode, Quantity,
  CAST(trunc(UnitPrice) AS BIGINT) AS UnitPrice, CustomerID,
  true AS ok_quantity, true AS ok_price, false AS ok_customer FROM raw""")
ORACLE["cast_date"] = with_(f"raw AS ({RAW_SQL})", """SELECT InvoiceNo, InvoiceDate AS d_iso,
  InvoiceDate AS d_fmt, Description, true AS ok_iso, true AS ok_fmt, false AS ok_text FROM raw""")

# ---- feature store --------------------------------------------------------
T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
BUILD_AS_OF, REFRESH_DAY = "1998-07-20", "1998-07-21"


def hash_key(ts: str, version: str) -> str:
    return (f"sha256(CAST(CustomerID AS VARCHAR) || '|' || '{ts}' || '|' || "
            f"CAST({version} AS VARCHAR))")


FEATS = "CustomerID, gross_revenue, recency_days, qty_products, frequency, qty_returns"
STORE_CTES = (
    base_ctes(f"DATE '{BUILD_AS_OF}'", "a_") + ",\n" + feature_ctes("a_t", "a_p", "a_r", "a_") + ",\n"
    + base_ctes(f"DATE '{REFRESH_DAY}'", "b_", with_raw=False) + ",\n"
    + f"""act AS (SELECT DISTINCT CAST(trunc(CustomerID) AS BIGINT) AS CustomerID FROM raw
        WHERE InvoiceDate = DATE '{REFRESH_DAY}' AND CustomerID IS NOT NULL),
b_ts AS (SELECT * FROM b_t WHERE CustomerID IN (SELECT CustomerID FROM act)),
b_ps AS (SELECT * FROM b_p WHERE CustomerID IN (SELECT CustomerID FROM act)),
b_rs AS (SELECT * FROM b_r WHERE CustomerID IN (SELECT CustomerID FROM act)),
""" + feature_ctes("b_ts", "b_ps", "b_rs", "b_") + ",\n"
    + f"""v1 AS (SELECT {FEATS}, {hash_key(T0, '1')} AS "values",
        TIMESTAMP '{T0}' AS "timestamp", 1 AS _version FROM a_feat),
nw AS (SELECT {FEATS}, {hash_key(T1, '2')} AS "values",
        TIMESTAMP '{T1}' AS "timestamp", 2 AS _version FROM b_feat),
u AS (SELECT * FROM v1 UNION ALL SELECT * FROM nw),
restamped AS (SELECT {FEATS},
        CASE WHEN CustomerID IN (SELECT CustomerID FROM act) THEN {hash_key(T1, '_version')}
             ELSE "values" END AS "values",
        CASE WHEN CustomerID IN (SELECT CustomerID FROM act) THEN TIMESTAMP '{T1}'
             ELSE "timestamp" END AS "timestamp", _version FROM v1),
refreshed AS (SELECT {FEATS},
        CASE WHEN CustomerID IN (SELECT CustomerID FROM act) THEN {hash_key(T1, '_version')}
             ELSE "values" END AS "values",
        CASE WHEN CustomerID IN (SELECT CustomerID FROM act) THEN TIMESTAMP '{T1}'
             ELSE "timestamp" END AS "timestamp", _version FROM u),
upserted AS (SELECT * FROM v1 WHERE CustomerID NOT IN (SELECT CustomerID FROM act)
             UNION ALL SELECT * FROM nw)""")
RF = "ROUND(gross_revenue, 2) AS gross_revenue"
# The first version over all dates.
FULL_CTES = base_ctes() + ",\n" + feature_ctes() + f""",
v1 AS (SELECT {FEATS}, {hash_key(T0, '1')} AS "values", TIMESTAMP '{T0}' AS "timestamp", 1 AS _version FROM feat)"""
ORACLE["feature_table"] = with_(FULL_CTES, f'SELECT * REPLACE ({RF}) FROM v1')
ORACLE["stamp"] = with_(FULL_CTES, f"""SELECT * EXCLUDE ("values") REPLACE ({RF}), true AS key_valid, true AS key_unique
FROM v1""")
ORACLE["normalise_types"] = with_(f"raw AS ({RAW_SQL})", "SELECT * FROM raw")
ORACLE["normalise_types_clean"] = with_(B, TYPED8)
ORACLE["write_refused"] = with_(B, """SELECT Country, count(*) AS n_lines, false AS existed_before,
  true AS refused, true AS exists_after FROM t GROUP BY Country""")
ORACLE["active_semi"] = with_(STORE_CTES, "SELECT * FROM b_ts")
ORACLE["restamp"] = with_(STORE_CTES, f"SELECT * REPLACE ({RF}) FROM restamped")
ORACLE["refresh"] = with_(STORE_CTES, f"SELECT * REPLACE ({RF}) FROM refreshed")
ORACLE["refresh_state"] = ORACLE["refresh"]
ORACLE["refresh_upsert"] = with_(STORE_CTES, f"SELECT * REPLACE ({RF}) FROM upserted")
ORACLE["read_instances"] = with_(FULL_CTES, 'SELECT "values", "timestamp" FROM v1')
STORE_TYPED = f'''SELECT "values", "timestamp", {RF}, CAST(recency_days AS DOUBLE) AS recency_days,
  CAST(qty_products AS DOUBLE) AS qty_products, frequency, qty_returns FROM '''
ORACLE["ingest"] = with_(FULL_CTES, STORE_TYPED + "v1")
ORACLE["train_set"] = with_(FULL_CTES, STORE_TYPED + "v1")
# Two versions: the log has the first, and what the refresh added or restamped.
ORACLE["ingest_two_versions"] = with_(STORE_CTES + """,
logged AS (SELECT * FROM v1 UNION ALL SELECT * FROM refreshed WHERE "values" NOT IN (SELECT "values" FROM v1))""",
    STORE_TYPED + "logged")
ORACLE["train_set_two_versions"] = with_(STORE_CTES, STORE_TYPED + "refreshed")
ORACLE["asof_serve"] = """WITH rd AS (SELECT event_id, event_type, user_id, ts FROM events),
ft AS (SELECT user_id, ts AS feat_ts, value AS feat_value, event_id AS feat_event_id
       FROM events WHERE event_type IN ('view', 'click')),
j AS (SELECT rd.event_id, rd.event_type, rd.user_id, rd.ts, ft.feat_ts, ft.feat_value, ft.feat_event_id,
        row_number() OVER (PARTITION BY rd.event_id
          ORDER BY ft.feat_ts DESC NULLS LAST, ft.feat_event_id DESC NULLS LAST) AS rn
      FROM rd LEFT JOIN ft ON rd.user_id = ft.user_id AND ft.feat_ts <= rd.ts)
SELECT event_id, event_type, user_id, ts, feat_ts, feat_value, feat_event_id FROM j WHERE rn = 1"""

# ---- clustering -----------------------------------------------------------
FEAT = B + ",\n" + feature_ctes()
_MF = ["qty_products", "qty_returns", "frequency", "recency_days"]
_pairs = [(a, b) for i, a in enumerate(_MF) for b in _MF[i:]]
ORACLE["feature_cov"] = with_(FEAT, " UNION ALL ".join(
    f"SELECT '{a}' AS row, '{b}' AS col, ROUND(covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) AS cov FROM feat"
    for a, b in _pairs))
SCALED = FEAT + """,
mm AS (SELECT min(recency_days) AS r0, max(recency_days) AS r1, min(frequency) AS f0,
              max(frequency) AS f1 FROM feat),
scaled AS (SELECT CustomerID,
  ROUND(CASE WHEN r1 = r0 THEN 0.5 ELSE (recency_days - r0) / (r1 - r0) END, 9) AS recency_days_mm,
  ROUND(CASE WHEN f1 = f0 THEN 0.5 ELSE (frequency - f0) / (f1 - f0) END, 9) AS frequency_mm
  FROM feat, mm)"""
ORACLE["minmax"] = with_(SCALED, "SELECT * FROM scaled")
_GRID = [[0.1, 0.1], [0.1, 0.5], [0.1, 0.9], [0.5, 0.1], [0.5, 0.9], [0.9, 0.1], [0.9, 0.5], [0.9, 0.9]]
_centres = " UNION ALL ".join(f"SELECT {i} AS i, {a} AS a, {b} AS b" for i, (a, b) in enumerate(_GRID))
ORACLE["cluster_assign"] = with_(SCALED + f",\ncentres AS ({_centres})", """SELECT CustomerID,
  CAST(arg_min(i, {'d': (recency_days_mm - a) * (recency_days_mm - a) + (frequency_mm - b) * (frequency_mm - b), 'i': i}) AS INTEGER) AS Clusters
FROM scaled, centres GROUP BY CustomerID""")



def _power(name: str, matrix: str, steps: int = 400) -> str:
    """Power iteration on a 4 x 4 matrix m11..m44: its largest eigenvalue and
    vector, as the one-row CTE ``name``."""
    cells = ", ".join(f"m{i}{j}" for i in range(1, 5) for j in range(1, 5))
    rows = ", ".join(" + ".join(f"m{i}{j} * v{j}" for j in range(1, 5)) + f" AS w{i}" for i in range(1, 5))
    unit = ", ".join(f"w{i} / norm AS v{i}" for i in range(1, 5))
    return f""",
{name}_it({cells}, v1, v2, v3, v4, norm, step) AS (
  SELECT {cells}, 0.5::DOUBLE, 0.4::DOUBLE, 0.3::DOUBLE, 0.2::DOUBLE, 1.0::DOUBLE, 0 FROM {matrix}
  UNION ALL
  SELECT {cells}, {unit}, norm, step + 1 FROM (SELECT *, sqrt(w1 * w1 + w2 * w2 + w3 * w3 + w4 * w4) AS norm FROM (
    SELECT * EXCLUDE (norm), {rows} FROM {name}_it WHERE step < {steps}))),
{name} AS (SELECT * FROM {name}_it WHERE step = {steps})"""


_F = ["qty_products", "qty_returns", "frequency", "recency_days"]
_cells = ", ".join(f"covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS m{i}{j}"
                   for i, a in enumerate(_F, 1) for j, b in enumerate(_F, 1))
_deflated = ", ".join(f"m{i}{j} - norm * v{i} * v{j} AS m{i}{j}" for i in range(1, 5) for j in range(1, 5))
ORACLE["pca_project"] = "WITH RECURSIVE " + FEAT + f""",
c1 AS (SELECT {_cells} FROM feat)""" + _power("e1", "c1") + f""",
c2 AS (SELECT {_deflated} FROM e1)""" + _power("e2", "c2") + """,
whole AS (SELECT m11 + m22 + m33 + m44 AS t FROM c1)
SELECT 1 AS component, ROUND(norm, 2) AS eigenvalue, ROUND(norm / t, 6) AS share, 0.0 AS low, 1.0 AS high FROM e1, whole
UNION ALL SELECT 2, ROUND(norm, 2), ROUND(norm / t, 6), 0.0, 1.0 FROM e2, whole"""
ORACLE["kmeans_train"] = "SELECT CAST(range AS INTEGER) AS cluster, true AS centre_is_mean FROM range(8)"
ORACLE["batch_predict"] = with_(FEAT, """SELECT CustomerID, qty_products, qty_returns, frequency, recency_days,
  true AS label_is_nearest FROM feat""")
ORACLE["model_reload"] = with_(FEAT, "SELECT CustomerID, true AS same_after_reload FROM feat")

# ---- forecasting ----------------------------------------------------------
def series_ctes(total: bool = False) -> str:
    """Gapless daily series over all dates, per country or in all (``total``)."""
    key = "'all'" if total else "Country"
    return B + f""",
daily AS (SELECT {key} AS Country, InvoiceDate, CAST(SUM(Quantity) AS BIGINT) AS Quantity FROM curated GROUP BY ALL),
span AS (SELECT Country, min(InvoiceDate) AS lo, max(InvoiceDate) AS hi FROM daily GROUP BY Country),
days AS (SELECT Country, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS InvoiceDate FROM span),
j AS (SELECT days.Country, days.InvoiceDate, CAST(daily.Quantity AS DOUBLE) AS y
      FROM days LEFT JOIN daily USING (Country, InvoiceDate)),
nb AS (SELECT *,
  last_value(CASE WHEN y IS NOT NULL THEN InvoiceDate END IGNORE NULLS) OVER w1 AS pd,
  last_value(y IGNORE NULLS) OVER w1 AS py,
  first_value(CASE WHEN y IS NOT NULL THEN InvoiceDate END IGNORE NULLS) OVER w2 AS nd,
  first_value(y IGNORE NULLS) OVER w2 AS ny
  FROM j WINDOW w1 AS (PARTITION BY Country ORDER BY InvoiceDate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                w2 AS (PARTITION BY Country ORDER BY InvoiceDate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
series AS (SELECT Country, InvoiceDate,
  CASE WHEN y IS NOT NULL THEN y ELSE py + (ny - py) * CAST(date_diff('day', pd, InvoiceDate) AS DOUBLE)
       / CAST(date_diff('day', pd, nd) AS DOUBLE) END AS Quantity, y IS NULL AS filled FROM nb)"""


SERIES = series_ctes()
TREND = """,
tr AS (SELECT *, CASE WHEN count(Quantity) OVER w = 7 THEN sum(Quantity) OVER w / 7.0 END AS trend,
         (date_diff('day', DATE '1970-01-01', InvoiceDate) % 7 + 7) % 7 AS phase
       FROM series WINDOW w AS (PARTITION BY Country ORDER BY InvoiceDate ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))"""
ORACLE["fill_calendar"] = with_(SERIES, "SELECT Country, InvoiceDate, ROUND(Quantity, 6) AS Quantity, filled FROM series")
ORACLE["fill_calendar_total"] = with_(series_ctes(True), "SELECT InvoiceDate, ROUND(Quantity, 6) AS Quantity, filled FROM series")
SEASON = TREND + """,
ph AS (SELECT Country, phase, avg(Quantity - trend) AS s FROM tr GROUP BY Country, phase),
ph2 AS (SELECT Country, phase, s - avg(s) OVER (PARTITION BY Country) AS seasonal FROM ph)"""
PARTS = """InvoiceDate, ROUND(Quantity, 6) AS Quantity, ROUND(trend, 6) AS trend,
  ROUND(seasonal, 6) + 0.0 AS seasonal, ROUND(Quantity - trend - seasonal, 6) + 0.0 AS residual
FROM tr LEFT JOIN ph2 USING (Country, phase)"""
ORACLE["decompose"] = with_(SERIES + SEASON, "SELECT Country, " + PARTS)
ORACLE["decompose_total"] = with_(series_ctes(True) + SEASON, "SELECT " + PARTS)


def line_ctes(n: str, table: str, source: str, out: str, half: int, stride: int = 1) -> str:
    """CTEs ``{n}`` (and ``{n}l``): adds ``out``, the tricube-weighted local
    line through ``source`` at each row, ``half`` steps on either side."""
    span = range(-half, half + 1)
    name = lambda j: f"g{j + half}"
    lags = ", ".join(f"lag({source}, {j * stride}) OVER w AS {name(j)}" for j in span)
    total = lambda power, value: " + ".join(
        f"coalesce({(1 - (abs(j) / (half + 1)) ** 3) ** 3 * (-j) ** power!r} * "
        f"{name(j) if value else f'({name(j)} * 0 + 1)'}, 0.0)" for j in span)
    return f""",
{n}l AS (SELECT *, {lags} FROM {table} WINDOW w AS (PARTITION BY Country ORDER BY InvoiceDate)),
{n} AS (SELECT * EXCLUDE ({', '.join(map(name, span))}, sw, sx, sxx, sy, sxy),
  CASE WHEN sw * sxx - sx * sx > 1e-9 THEN (sy * sxx - sxy * sx) / (sw * sxx - sx * sx) ELSE sy / sw END AS {out}
  FROM (SELECT *, {total(0, False)} AS sw, {total(1, False)} AS sx, {total(2, False)} AS sxx,
        {total(0, True)} AS sy, {total(1, True)} AS sxy FROM {n}l))"""


def season_ctes() -> str:
    """``parts``: the weekly seasonal-trend decomposition; ``adj``: without
    the season."""
    out, table = "", "(SELECT Country, InvoiceDate, Quantity, 0.0::DOUBLE AS trend FROM series)"
    near = ", ".join(["m"] + [f"lead(m, {k}) OVER w" for k in (1, 2, 3)] + [f"lag(m, {k}) OVER w" for k in (1, 2, 3)])
    for i in (1, 2):
        out += f""",
sx{i} AS (SELECT * EXCLUDE (trend), Quantity - trend AS x FROM {table})""" + line_ctes(f"sc{i}", f"sx{i}", "x", "c", 3, 7) + f""",
sm{i} AS (SELECT *, CASE WHEN count(c) OVER w = 7 THEN sum(c) OVER w / 7.0 END AS m FROM sc{i}
  WINDOW w AS (PARTITION BY Country ORDER BY InvoiceDate ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ss{i} AS (SELECT Country, InvoiceDate, Quantity, coalesce(c - coalesce({near}), 0.0) AS seasonal FROM sm{i}
  WINDOW w AS (PARTITION BY Country ORDER BY InvoiceDate)),
sd{i} AS (SELECT *, Quantity - seasonal AS x FROM ss{i})""" + line_ctes(f"st{i}", f"sd{i}", "x", "trend", 7)
        table = f"(SELECT Country, InvoiceDate, Quantity, trend FROM st{i})"
    return out + """,
parts AS (SELECT Country, InvoiceDate, Quantity, trend, seasonal, Quantity - trend - seasonal AS residual FROM st2),
adj AS (SELECT Country, InvoiceDate, Quantity - seasonal AS Quantity FROM parts)"""


ORACLE["seasonal_trend"] = with_(SERIES + season_ctes(), """SELECT Country, InvoiceDate, ROUND(Quantity, 5) AS Quantity,
  ROUND(trend, 5) + 0.0 AS trend, ROUND(seasonal, 5) + 0.0 AS seasonal, ROUND(residual, 5) + 0.0 AS residual FROM parts""")


def anomaly_ctes(rounds: int = 3) -> str:
    """``marked``: spikes, dips and steps of ``parts``, and the values without."""
    out = """,
an1 AS (SELECT Country, InvoiceDate, Quantity, seasonal, Quantity - seasonal AS x,
  median(Quantity - seasonal) OVER (PARTITION BY Country ORDER BY InvoiceDate ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS m FROM parts),
an2 AS (SELECT *, x - m AS dev, median(abs(x - m)) OVER (PARTITION BY Country ORDER BY InvoiceDate
  ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS a FROM an1),
an3 AS (SELECT * REPLACE (CASE WHEN a > 0 AND abs(dev) > 5.0 * 1.4826 * a THEN m ELSE x END AS x),
  a > 0 AND dev > 5.0 * 1.4826 * a AS spike, a > 0 AND -dev > 5.0 * 1.4826 * a AS dip FROM an2),
an4 AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY Country ORDER BY InvoiceDate)) AS nd FROM an3),
cut0 AS (SELECT *, median(nd) OVER (PARTITION BY Country) * (1.4826 / sqrt(2)) AS noise, 1 AS g, NULL::DOUBLE AS jump FROM an4)"""
    for i in range(1, rounds + 1):
        out += f""",
ctr{i} AS (SELECT *, x - avg(x) OVER (PARTITION BY Country, g) AS c FROM cut{i - 1}),
scr{i} AS (SELECT *, abs(sum(c) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS far,
  count(*) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) = 14 AND count(*) OVER (w ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) = 14 AS whole,
  avg(x) OVER (w ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) - avg(x) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS up
  FROM ctr{i} WINDOW w AS (PARTITION BY Country, g ORDER BY InvoiceDate)),
top{i} AS (SELECT Country, g, InvoiceDate + 1 AS first, up FROM scr{i} WHERE whole
  QUALIFY row_number() OVER (PARTITION BY Country, g ORDER BY far DESC) = 1),
cut{i} AS (SELECT p.* REPLACE (CASE WHEN p.InvoiceDate = t.first THEN t.up ELSE p.jump END AS jump,
    2 * p.g + CASE WHEN p.InvoiceDate >= t.first THEN 1 ELSE 0 END AS g)
  FROM cut{i - 1} p LEFT JOIN top{i} t ON p.Country = t.Country AND p.g = t.g AND p.noise > 0 AND abs(t.up) >= 5.0 * p.noise)"""
    return out + f""",
marked AS (SELECT Country, InvoiceDate, Quantity, spike, dip, jump IS NOT NULL AS step, x + seasonal AS cleaned,
  x + seasonal + coalesce(sum(jump) OVER (PARTITION BY Country ORDER BY InvoiceDate ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0.0) AS steady
  FROM cut{rounds})"""


ORACLE["series_anomalies"] = with_(SERIES + season_ctes() + anomaly_ctes(), """SELECT Country, InvoiceDate,
  ROUND(Quantity, 5) AS Quantity, spike, dip, step, ROUND(cleaned, 5) + 0.0 AS cleaned, ROUND(steady, 5) + 0.0 AS steady FROM marked""")


def solve_ctes(orders: int) -> tuple[str, list[str]]:
    """From the moments ``mts`` of the lagged shocks and values to ``solved``:
    elimination without pivoting for q = 0, 1, 2 lagged shocks (first) and all
    lagged values, the coefficients of every order, its squared error, and the
    partial autocorrelations of its autoregressive part. One CTE a step. Also
    the candidates with q > 0, one SELECT each."""
    place = ["z", "e1", "e2", *(f"z{i}" for i in range(1, orders + 1))]
    moment = lambda a, b: "s_" + "_".join(sorted((a, b), key=place.index))
    names = {q: [f"e{i}" for i in range(1, q + 1)] + [f"z{i}" for i in range(1, orders + 1)] for q in range(3)}
    todo = [(p, q) for q in (1, 2) for p in range(orders + 1)]
    steps: list[tuple[bool, dict[str, str]]] = []
    first = {}
    for q, some in names.items():
        for i, a in enumerate(some):
            first[f"c{q}_{i}"] = moment("z", a)
            first |= {f"u{q}_{i}_{j}": moment(a, some[j]) for j in range(i, len(some))}
    steps.append((False, first))
    for k in range(orders + 2):
        step = {}
        for q, some in names.items():
            for i in range(k + 1, len(some)):
                times = f"coalesce(u{q}_{k}_{i} / nullif(u{q}_{k}_{k}, 0), 0)"
                step[f"c{q}_{i}"] = f"c{q}_{i} - {times} * c{q}_{k}"
                step |= {f"u{q}_{i}_{j}": f"u{q}_{i}_{j} - {times} * u{q}_{k}_{j}" for j in range(i, len(some))}
        if step:
            steps.append((True, step))
    steps.append((False, {f"r{q}_{p}": " - ".join(["s_z_z"] + [f"coalesce(c{q}_{i} * c{q}_{i} / nullif(u{q}_{i}_{i}, 0), 0)"
                                                           for i in range(p + q)]) for q in names for p in range(orders + 1)}))
    for back in range(orders + 2):
        steps.append((False, {f"x{q}_{p}_{i}": "(" + " - ".join([f"c{q}_{i}"] + [f"u{q}_{i}_{j} * x{q}_{p}_{j}" for j in range(i + 1, p + q)])
                              + f") / nullif(u{q}_{i}_{i}, 0)" for p, q in todo if (i := p + q - 1 - back) >= 0}))
    steps.append((False, {f"f{q}_{p}_{i}": f"x{q}_{p}_{q + i}" for p, q in todo for i in range(p)}))
    for down in range(orders - 1):  # partial autocorrelations from the last one down
        step = {}
        for p, q in todo:
            top = p - 1 - down
            k = f"f{q}_{p}_{top}"
            step |= {f"f{q}_{p}_{i}": f"(f{q}_{p}_{i} + {k} * f{q}_{p}_{top - 1 - i}) / nullif(1 - {k} * {k}, 0)"
                     for i in range(top if top > 0 else 0)}
        steps.append((True, step))
    text, table = "", "mts"
    for number, (replaces, step) in enumerate(steps):
        columns = ", ".join(f"{v} AS {n}" for n, v in step.items())
        name = "eliminated" if number == len(steps) - 1 else f"step{number}"
        text += f""",
{name} AS MATERIALIZED (SELECT * {f'REPLACE ({columns})' if replaces else ', ' + columns} FROM {table})"""
        table = name
    rows = []
    for p, q in todo:
        x = lambda i: f"x{q}_{p}_{i}"  # noqa: B023, E731
        ok = [f"u{q}_{i}_{i} > 1e-9 * {moment(a, a)}" for i, a in enumerate(names[q][:p + q])]
        ok += [f"abs({x(0)}) < 1"] if q == 1 else [f"abs({x(1)}) < 1", f"{x(1)} + {x(0)} > -1", f"{x(1)} - {x(0)} > -1"]
        ok += [f"abs(f{q}_{p}_{i}) < 1" for i in range(p)]
        ar = ", ".join(f"{x(q + i)} AS ar{i + 1}" if i < p else f"NULL AS ar{i + 1}" for i in range(orders))
        ma = ", ".join(f"{x(i)} AS ma{i + 1}" if i < q else f"NULL AS ma{i + 1}" for i in (0, 1))
        rows.append(f"SELECT Country, {p}, {q}, d, n, mean, v{p} * r{q}_{p} / nullif(r0_{p}, 0), {ar}, {ma}, sh1, sh2 "
                    f"FROM solved WHERE days >= 30 AND r{q}_{p} > 0 AND r0_{p} > 0 AND " + " AND ".join(ok))
    return text, rows


def arima_ctes(lags: int = 7, orders: int = 5, source: str = "series") -> str:
    """Autocovariances, KPSS, Levinson-Durbin, lagged shocks, candidates and
    best orders."""
    prods = ", ".join(f"coalesce(z * lag(z, {k}) OVER w, 0.0) AS p{k}" for k in range(1, lags + 1))
    sums = ", ".join(f"sum(p{k}) / count(*) AS r{k}" for k in range(lags + 1))
    long_run = " + ".join(["r0"] + [f"r{k} * {2 * (1 - k / (lags + 1))!r}" for k in range(1, lags + 1)])
    out = f""",
x1 AS (SELECT Country, InvoiceDate AS t, Quantity AS x0,
   Quantity - lag(Quantity) OVER (PARTITION BY Country ORDER BY InvoiceDate) AS x1 FROM {source}),
x2 AS (SELECT *, x1 - lag(x1) OVER (PARTITION BY Country ORDER BY t) AS x2 FROM x1),
lng AS (SELECT Country, t, 0 AS d, x0 AS x FROM x2 UNION ALL SELECT Country, t, 1, x1 FROM x2 WHERE x1 IS NOT NULL
        UNION ALL SELECT Country, t, 2, x2 FROM x2 WHERE x2 IS NOT NULL),
ctr AS (SELECT *, CASE WHEN d < 2 THEN avg(x) OVER (PARTITION BY Country, d) ELSE 0.0 END AS mean FROM lng),
zz AS (SELECT *, x - mean AS z FROM ctr),
lg AS (SELECT Country, d, mean, sum(z) OVER w AS c, z * z AS p0, {prods}
       FROM zz WINDOW w AS (PARTITION BY Country, d ORDER BY t)),
mom AS (SELECT Country, d, count(*) AS n, max(mean) AS mean, sum(c * c) AS cc, {sums} FROM lg GROUP BY Country, d),
lr AS (SELECT *, {long_run} AS lr FROM mom),
l0 AS (SELECT *, r0 AS v0 FROM lr WHERE d = 2 OR CASE WHEN lr > 1e-12 * r0 THEN cc / (CAST(n AS DOUBLE) * n * lr) ELSE 0.0 END <= 0.463
       QUALIFY row_number() OVER (PARTITION BY Country ORDER BY d) = 1)"""
    none = "CAST(NULL AS DOUBLE) AS ma1, CAST(NULL AS DOUBLE) AS ma2, 0.0::DOUBLE AS sh1, 0.0::DOUBLE AS sh2"
    cands = ["SELECT Country, 0 AS p, 0 AS q, d, n, mean, v0 AS variance, " + ", ".join(
        f"CAST(NULL AS DOUBLE) AS ar{i + 1}" for i in range(orders)) + f", {none} FROM l{lags}"]
    for p in range(1, lags + 1):
        inner = " - ".join([f"r{p}"] + [f"a{p - 1}_{i} * r{p - 1 - i}" for i in range(p - 1)])
        new = "".join(f", a{p - 1}_{i} - k{p} * a{p - 1}_{p - 2 - i} AS a{p}_{i}" for i in range(p - 1))
        out += f""",
k{p} AS (SELECT *, CASE WHEN v{p - 1} > 0 THEN ({inner}) / v{p - 1} ELSE 0.0 END AS k{p} FROM l{p - 1}),
l{p} AS (SELECT *{new}, k{p} AS a{p}_{p - 1}, greatest(0.0, v{p - 1} * (1 - k{p} * k{p})) AS v{p} FROM k{p})"""
        cols = [f"a{p}_{i} AS ar{i + 1}" if i < p else f"NULL AS ar{i + 1}" for i in range(orders)]
        if p <= orders:
            cands.append(f"SELECT Country, {p}, 0, d, n, mean, v{p}, {', '.join(cols)}, {none} FROM l{lags}")
    shock = " - ".join(["z"] + [f"a{lags}_{k - 1} * lag(z, {k}) OVER w" for k in range(1, lags + 1)])
    names = ["z", "e1", "e2", *(f"z{i}" for i in range(1, orders + 1))]
    products = ", ".join(f"sum({a} * {b}) FILTER (WHERE e2 IS NOT NULL) AS s_{a}_{b}" for i, a in enumerate(names) for b in names[i:])
    solved, rows = solve_ctes(orders)
    cands += rows
    return out + f""",
shk AS (SELECT Country, t, z, {shock} AS e0 FROM zz JOIN l{lags} USING (Country, d) WINDOW w AS (PARTITION BY Country ORDER BY t)),
lgd AS (SELECT *, lag(e0, 1) OVER w AS e1, lag(e0, 2) OVER w AS e2, {', '.join(f'lag(z, {i}) OVER w AS z{i}' for i in range(1, orders + 1))}
        FROM shk WINDOW w AS (PARTITION BY Country ORDER BY t)),
mts AS (SELECT Country, count(*) FILTER (WHERE e2 IS NOT NULL) AS days, {products},
        arg_max(coalesce(e0, 0.0), t) AS sh1, arg_max(coalesce(e1, 0.0), t) AS sh2 FROM lgd GROUP BY Country){solved},
solved AS MATERIALIZED (SELECT * FROM eliminated JOIN
           (SELECT Country, d, n, mean, {', '.join(f'v{p}' for p in range(orders + 1))} FROM l{lags}) USING (Country)),
cand0 AS ({' UNION ALL '.join(cands)}),
cand AS (SELECT *, CASE WHEN variance > 0 THEN -n / 2.0 * (ln(2 * pi() * variance) + 1) END AS ll FROM cand0),
scored AS (SELECT *, 2 * (p + q + 1 + CASE WHEN d < 2 THEN 1 ELSE 0 END) - 2 * ll AS aic FROM cand),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY Country ORDER BY coalesce(round(aic, 8), 0.0), p + q, q) = 1)"""


MODEL_COLS = """Country, p AS non_seasonal_p, d AS non_seasonal_d, q AS non_seasonal_q, d = 1 AS has_drift,
  ROUND(ll, 4) AS log_likelihood, ROUND(aic, 4) AS AIC, ROUND(variance, 4) AS variance,
  ROUND(ar1, 6) + 0.0 AS ar1, ROUND(ar2, 6) + 0.0 AS ar2, ROUND(ar3, 6) + 0.0 AS ar3, ROUND(ar4, 6) + 0.0 AS ar4,
  ROUND(ar5, 6) + 0.0 AS ar5, ROUND(ma1, 6) + 0.0 AS ma1, ROUND(ma2, 6) + 0.0 AS ma2, ROUND(mean, 6) + 0.0 AS intercept_or_drift, CAST(n AS INTEGER) AS n_points"""
ORACLE["arima_evaluate"] = with_(SERIES + season_ctes() + anomaly_ctes() + arima_ctes(), f"""SELECT {MODEL_COLS},
  has_spikes_and_dips, has_step_changes FROM scored JOIN (SELECT Country, bool_or(spike OR dip) AS has_spikes_and_dips,
  bool_or(step) AS has_step_changes FROM marked GROUP BY Country) USING (Country)""")
ORACLE["arima_fit"] = with_(SERIES + arima_ctes(), f"SELECT {MODEL_COLS} FROM best")
ORACLE["arima_fit_seasonal"] = with_(SERIES + season_ctes() + arima_ctes(source="adj"), f"SELECT {MODEL_COLS} FROM best")


def forecast_ctes(horizon: int, orders: int = 5) -> str:
    """The steps ahead as a recursive CTE (state: last values and shocks, psi
    weights), from the adjusted series; the last week's season is added."""
    zs = [f"z{i}" for i in range(1, orders + 1)]
    ps = [f"s{i}" for i in range(1, orders + 1)]
    diff = lambda i: f"(y[{i}] - y[{i + 1}])"
    init = ", ".join(f"coalesce(CASE d WHEN 0 THEN y[{i}] WHEN 1 THEN {diff(i)} ELSE {diff(i)} - {diff(i + 1)} END - mean, 0.0) AS z{i}"
                     for i in range(1, orders + 1))
    dot = lambda cols: " + ".join(f"coalesce(ar{i + 1}, 0.0) * {c}" for i, c in enumerate(cols))
    model = "Country, d, mean, variance, ar1, ar2, ar3, ar4, ar5, ma1, ma2, last, ss"
    state = f"h, {', '.join(zs)}, e1, e2, {', '.join(ps)}, y0, s0, bend, moved, psi1, psi2, total"
    return f""",
lasty AS (SELECT Country, max(InvoiceDate) AS last, list(Quantity - seasonal ORDER BY InvoiceDate DESC) AS y,
          list(seasonal ORDER BY InvoiceDate DESC)[1:7] AS ss FROM parts GROUP BY Country),
rec({model}, {state}) AS (
  SELECT {model}, 0, {init}, sh1, sh2, {', '.join(['0.0::DOUBLE'] * orders)}, y[1], coalesce({diff(1)}, 0.0),
    0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  FROM best JOIN lasty USING (Country)
  UNION ALL
  SELECT {model}, h, zn, {', '.join(zs[:-1])}, 0.0, e1, pn, {', '.join(ps[:-1])}, y0, s0, bend + zn,
    CASE d WHEN 0 THEN zn WHEN 1 THEN moved + zn ELSE moved + bend + zn END, q1, psi2 + q1,
    total + CASE d WHEN 0 THEN pn * pn WHEN 1 THEN q1 * q1 ELSE (psi2 + q1) * (psi2 + q1) END
  FROM (SELECT *, psi1 + pn AS q1 FROM (
      SELECT * REPLACE (h + 1 AS h), {dot(zs)} + coalesce(ma1, 0.0) * e1 + coalesce(ma2, 0.0) * e2 AS zn,
        CASE h WHEN 0 THEN 1.0 ELSE {dot(ps)} + CASE h WHEN 1 THEN coalesce(ma1, 0.0) WHEN 2 THEN coalesce(ma2, 0.0) ELSE 0.0 END END AS pn
      FROM rec WHERE h < {horizon}))),
fc AS (SELECT Country, CAST(last + h AS DATE) AS ts, tr, ar, sn, tr + ar + sn AS val, se FROM (
  SELECT *, CASE d WHEN 0 THEN mean WHEN 1 THEN y0 + h * mean ELSE y0 + h * s0 END AS tr, moved AS ar,
    coalesce(ss[((7 - h % 7) % 7) + 1], 0.0) AS sn, sqrt(variance * total) AS se FROM rec WHERE h > 0))"""


_Q = "1.2815515655446008"
BOUNDS = f"""ROUND(se, 4) AS standard_error, 0.8::DOUBLE AS confidence_level,
  ROUND(val - {_Q} * se, 4) + 0.0 AS prediction_interval_lower_bound,
  ROUND(val + {_Q} * se, 4) + 0.0 AS prediction_interval_upper_bound"""


def recursive(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{body}"


def _forecast_sql(total: bool) -> str:
    key = "" if total else "Country, "
    return recursive(series_ctes(total) + season_ctes() + arima_ctes(source="adj") + forecast_ctes(10), f"""
SELECT {key}ts AS forecast_timestamp, ROUND(val, 4) + 0.0 AS forecast_value, {BOUNDS} FROM fc""")


ORACLE["forecast"] = _forecast_sql(False)
ORACLE["forecast_total"] = _forecast_sql(True)
ORACLE["explain_forecast"] = recursive(SERIES + season_ctes() + arima_ctes(source="adj") + forecast_ctes(30), f"""
SELECT Country, InvoiceDate AS time_series_timestamp, 'history' AS time_series_type, ROUND(Quantity, 4) AS time_series_data,
  NULL::DOUBLE AS standard_error, NULL::DOUBLE AS confidence_level, NULL::DOUBLE AS prediction_interval_lower_bound,
  NULL::DOUBLE AS prediction_interval_upper_bound, ROUND(trend, 4) + 0.0 AS trend, ROUND(seasonal, 4) + 0.0 AS seasonal,
  ROUND(residual, 4) + 0.0 AS residual FROM parts
UNION ALL SELECT Country, ts, 'forecast', ROUND(val, 4) + 0.0, {BOUNDS}, ROUND(tr, 4) + 0.0, ROUND(sn, 4) + 0.0,
  ROUND(ar, 4) + 0.0 FROM fc""")

# ---- streaming ------------------------------------------------------------
ORACLE["stream_build"] = with_(base_ctes() + ",\n" + feature_ctes(), f"""SELECT {FEATS.replace('gross_revenue', 'ROUND(gross_revenue, 2) AS gross_revenue')},
  {hash_key(T0, '1')} AS "values", TIMESTAMP '{T0}' AS "timestamp", 1 AS _version FROM feat""")
