"""Refresh from a stored state against the full build."""

import datetime as dt
import random

import pytest
from conftest import D, raw_df

from basketlab.operators import features, store
from basketlab.operators.state import CustomerState, refresh_from_state
from basketlab.session import scratch_path
from basketlab.sources.versioned import VersionedTable


def lines(seed, days, n=60):
    """Raw lines of some days: returns, rows without customer, repeated invoices."""
    rng = random.Random(seed)
    out = []
    for day in days:
        for _ in range(n):
            c = rng.choice([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None])
            out.append((f"i{rng.randint(1, 20)}", f"s{rng.randint(1, 5)}", "d", rng.choice([1, 2, 5, -1, -3]),
                        day, rng.choice([1.5, 2.25]), c, "x"))
    return out


def typed_of(spark, rows):
    df = raw_df(spark, rows)
    return df.withColumn("CustomerID", df["CustomerID"].cast("bigint"))


def as_set(df):
    return {(r.CustomerID, round(r.gross_revenue, 6), r.recency_days, r.qty_products, round(r.frequency, 9), r.qty_returns)
            for r in df.collect()}


DAYS = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(12)]


def test_days_one_after_the_other_equal_the_full_build(spark):
    state = CustomerState(spark, scratch_path(spark, "t-state"))
    all_lines = lines(1, DAYS[:6])
    state.build(typed_of(spark, all_lines))
    with pytest.raises(FileExistsError):
        state.build(typed_of(spark, all_lines))
    for i, day in enumerate(DAYS[6:10]):
        new = lines(10 + i, [day], n=25)
        all_lines += new
        assert state.update(typed_of(spark, new), day) is False
        assert as_set(state.features()) == as_set(features.customer_features(typed_of(spark, all_lines)))


def test_late_lines_open_their_day_again(spark):
    state = CustomerState(spark, scratch_path(spark, "t-state"))
    first = lines(2, DAYS[:4])
    state.build(typed_of(spark, first))
    new = lines(3, [DAYS[4]])
    assert state.update(typed_of(spark, new), DAYS[4]) is False
    for day in (DAYS[2], DAYS[4]):  # a day of the base, and one with its own folder
        late = lines(4, [day], n=10)
        mine = [r for r in first + new if r[4] == day] + late
        first = [r for r in first if r[4] != day]
        new = [r for r in new if r[4] != day]
        first += mine
        assert state.update(typed_of(spark, mine), day) is True
        assert as_set(state.features()) == as_set(features.customer_features(typed_of(spark, first + new)))


def test_a_job_that_died_before_the_totals_is_repeated(spark):
    state = CustomerState(spark, scratch_path(spark, "t-state"))
    first, new = lines(5, DAYS[:3]), lines(6, [DAYS[3]])
    state.build(typed_of(spark, first))
    whole = state._total

    def dies(*_):
        raise RuntimeError("lost")

    state._total = dies
    with pytest.raises(RuntimeError):
        state.update(typed_of(spark, new), DAYS[3])
    state._total = whole
    assert as_set(state.features()) == as_set(features.customer_features(typed_of(spark, first)))
    state.update(typed_of(spark, new), DAYS[3])
    assert as_set(state.features()) == as_set(features.customer_features(typed_of(spark, first + new)))


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_refresh_reads_one_day_and_equals_the_refresh_over_all(spark, mode):
    first, day = lines(7, DAYS[:5]), DAYS[5]
    new = [r for r in lines(8, [day], n=8)]
    tables = []
    for i in range(2):
        vt = VersionedTable(spark, scratch_path(spark, f"t-table{i}"))
        store.build_feature_table(vt, typed_of(spark, first), at="2020-01-06 00:00:00", key="hash")
        tables.append(vt)
    state = CustomerState(spark, scratch_path(spark, "t-state"))
    state.build(typed_of(spark, first))
    store.refresh_features(tables[0], typed_of(spark, first + new), raw_df(spark, first + new), day,
                           at="2020-01-07 00:00:00", key="hash", mode=mode)
    # The state's way is given the day's lines alone.
    refresh_from_state(tables[1], state, typed_of(spark, new), raw_df(spark, new), day,
                       at="2020-01-07 00:00:00", key="hash", mode=mode)
    rows = [sorted((r.CustomerID, round(r.gross_revenue, 6), r.recency_days, r.qty_products, round(r.frequency, 9),
                    r.qty_returns, r["values"], r.timestamp, r._version) for r in vt.read().collect()) for vt in tables]
    assert rows[0] == rows[1] and len(rows[0]) > 0


def test_a_day_without_lines(spark):
    state = CustomerState(spark, scratch_path(spark, "t-state"))
    first = lines(9, DAYS[:2])
    state.build(typed_of(spark, first))
    vt = VersionedTable(spark, scratch_path(spark, "t-table"))
    store.build_feature_table(vt, typed_of(spark, first), at="2020-01-06 00:00:00", key="hash")
    empty = typed_of(spark, [])
    assert refresh_from_state(vt, state, empty, raw_df(spark, []), DAYS[2]) is None
    assert vt.current_version() == 1 and as_set(state.features()) == as_set(features.customer_features(typed_of(spark, first)))
