"""Hand-written edge rows: each semantic the features must keep."""

import math

from conftest import D, raw_df

from basketlab.operators import clean, features, prepare

DAY1, DAY2, DAY9 = D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 9)


def line(inv, cust, qty, day, code="A1", price=1.0, desc="x", country="UK"):
    return (inv, code, desc, qty, day, price, None if cust is None else float(cust), country)


EDGE = [
    line("i1", 1, 0, DAY1),                                   # zero quantity
    line("i2", 2, -3, DAY1),                                  # return only
    line("i3", 3, 5, DAY1, price=2.0), line("r3", 3, -1, DAY9),  # return after last purchase
    line("A", 4, 1, DAY1), line("A", 4, 1, DAY2),             # invoice on two dates
    line("i5", 5, 2, DAY1), line("i5", 5, 2, DAY1), line("i5", 5, 2, DAY1),  # repeated lines
    line("i6a", 6, 1, DAY1), line("i6b", 6, 1, DAY1),         # two invoices on one day
    line("i7", 7, 4, DAY2, price=0.5),                        # no returns
    line("n1", None, 1, DAY1),                                # no customer
]


def feats(spark, rows):
    typed = prepare.cast_trusted(clean.not_null_rows(raw_df(spark, rows), D(2030, 1, 1))
                                 .where("CustomerID is not null"))
    return {r["CustomerID"]: r.asDict() for r in features.customer_features(typed).collect()}


def test_edge_rows(spark):
    f = feats(spark, EDGE)
    assert 2 not in f                                     # return-only customer vanishes
    assert f[1]["gross_revenue"] == 0.0 and f[1]["qty_products"] == 1
    assert f[1]["frequency"] == 1.0                       # one buy on one day
    assert f[3]["recency_days"] == 8                      # anchor includes the return date
    assert f[3]["qty_returns"] == 1 and f[3]["gross_revenue"] == 10.0
    assert f[4]["frequency"] == 1.0                       # buy_ 2 over days_ 2
    assert f[5]["qty_products"] == 3 and f[5]["frequency"] == 1.0
    assert f[6]["frequency"] == 2.0
    assert f[7]["qty_returns"] == 0 and f[7]["gross_revenue"] == 2.0


def test_fused_equals_joined(spark):
    typed = prepare.cast_trusted(raw_df(spark, EDGE[:-1]))
    a = sorted(tuple(r) for r in features.customer_features(typed).collect())
    f, p, r = prepare.prepare(raw_df(spark, EDGE[:-1]), trusted=True)
    b = sorted(tuple(r) for r in features.features_join(f, p, r).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[0] == y[0] and x[2:4] == y[2:4] and x[5] == y[5]
        assert math.isclose(x[1], y[1]) and math.isclose(x[4], y[4])


def test_frequency_details(spark):
    f, p, r = prepare.prepare(raw_df(spark, EDGE[:-1]), trusted=True)
    rows = {x["CustomerID"]: x for x in features.frequency(p).collect()}
    assert rows[4]["buy_"] == 2 and rows[4]["days_"] == 2
    assert rows[5]["buy_"] == 1
    assert rows[6]["days_"] == 1


def test_cleaning_rules(spark):
    asof = D(2020, 6, 1)
    rows = [
        line("c1", 10, 1, DAY1, code="m"), line("c2", 10, 1, DAY1, code="M"),
        line("c3", 10, 1, DAY1, code="d"),                     # case-sensitive codes
        line("p1", 11, 1, DAY1, price=0.04), line("p2", 11, 1, DAY1, price=0.0399),
        line("n1", 12, 1, DAY1, country=None), line("n2", 12, 1, DAY1, code=None),
        line("n3", 12, 1, DAY1, price=None),
        line("x1", 16446, 1, DAY1),                            # excluded customer
        line("f1", 13, 1, D(2020, 6, 2)),                      # future
        line("e1", 14, 1, DAY1, country="Unspecified"),
        line("d1", 15, 1, DAY1, desc=None),
        line("nan1", 16, 1, DAY1, price=float("nan")),
        ("nan2", "A1", "x", 1, DAY1, 1.0, float("nan"), "UK"),
    ]
    kept = {r["InvoiceNo"] for r in clean.curate(raw_df(spark, rows), asof).collect()}
    assert kept == {"c3", "p1"}


def test_null_quantity_in_neither_branch(spark):
    rows = [line("q", 1, None, DAY1), line("q2", 1, 2, DAY1)]
    f, p, r = prepare.prepare(raw_df(spark, rows), trusted=True)
    assert f.count() == 2 and p.count() == 1 and r.count() == 0


def test_require(spark):
    import pytest
    df = raw_df(spark, EDGE)
    prepare.require(df, ["CustomerID", "Quantity"], "df", non_empty=True)
    with pytest.raises(ValueError):
        prepare.require(df, ["nope"], "df")
    with pytest.raises(ValueError):
        prepare.require(df.limit(0), ["CustomerID"], "df", non_empty=True)
