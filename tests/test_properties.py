"""Property tests on random invoice lines."""


from conftest import D, raw_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketlab.operators import features, prepare

lines = st.lists(st.tuples(
    st.sampled_from(["i1", "i2", "i3", "i4"]),             # invoice
    st.sampled_from(["A", "B", None]),                    # stock code
    st.one_of(st.none(), st.integers(-5, 5)),             # quantity
    st.integers(0, 20),                                   # day offset
    st.sampled_from([0.5, 1.25, 3.0, None]),              # price
    st.one_of(st.none(), st.integers(1, 4)),              # customer
), min_size=1, max_size=40)


def rows(ls):
    return [(inv, code, "x", q, D(2020, 1, 1 + d), p, None if c is None else float(c), "UK")
            for inv, code, q, d, p, c in ls]


def as_set(df):
    out = {}
    for r in df.collect():
        out[r["CustomerID"]] = (round(r["gross_revenue"], 6), r["recency_days"], r["qty_products"],
                                round(r["frequency"], 9), r["qty_returns"])
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines)
def test_fused_equals_joined_and_partitioning_invariant(spark, ls):
    raw = raw_df(spark, rows(ls))
    typed = prepare.cast_trusted(raw)
    fused = as_set(features.customer_features(typed))
    f, p, r = prepare.prepare(raw, trusted=True)
    assert fused == as_set(features.features_join(f, p, r))
    assert fused == as_set(features.customer_features(typed.repartition(3).sortWithinPartitions("Quantity")))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines)
def test_every_row_in_exactly_one_branch(spark, ls):
    f, p, r = prepare.prepare(raw_df(spark, rows(ls)), trusted=True)
    n_null_q = sum(1 for x in ls if x[2] is None)
    assert p.count() + r.count() + n_null_q == f.count()


def brute_features(ls):
    """The five features from their definitions, in plain Python."""
    rs = [(inv, code, q, D(2020, 1, 1 + d), p, c) for inv, code, q, d, p, c in ls]
    anchor = max(r[3] for r in rs)                      # latest date of the whole frame
    out = {}
    for c in {r[5] for r in rs if r[5] is not None}:
        mine = [r for r in rs if r[5] == c]
        buys = [r for r in mine if r[2] is not None and r[2] >= 0]
        if not buys:
            continue                                     # return-only customers vanish
        visits = {(r[0], r[3]) for r in buys}            # distinct (invoice, date)
        days = (max(r[3] for r in buys) - min(r[3] for r in buys)).days + 1
        out[c] = (round(sum(r[2] * r[4] for r in buys if r[4] is not None), 6),
                  (anchor - max(r[3] for r in buys)).days,
                  sum(1 for r in buys if r[1] is not None),
                  round(len(visits) / days, 9),
                  -sum(r[2] for r in mine if r[2] is not None and r[2] < 0))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines)
def test_fused_matches_definition(spark, ls):
    typed = prepare.cast_trusted(raw_df(spark, rows(ls)))
    assert as_set(features.customer_features(typed)) == brute_features(ls)
