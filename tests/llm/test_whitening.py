import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import sf  # noqa: F401

from basketlab.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component int, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 9, 1) for i, v in rows], SCHEMA)


def brute(rows, most=32):
    """From the definitions, with numpy's own eigenvalues."""
    ok = [(i, np.array(v, dtype="f4").astype("f8")) for i, v in rows if v is not None and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all()]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in ok], dtype=object)
    n, s = len(x), x.sum(axis=0)
    d = (x - s // n).astype(float) - np.array([(int(t) % n) / n for t in s])
    v = d.T @ d / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    deviation = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s, strict=True)) for row in x]
    return [i for i, _ in ok], n, deviation, d @ q / np.sqrt(e), e / v.trace()


def matrix(df):
    """Rows by id, in order of the component."""
    by = {}
    for r in sorted(df.collect(), key=lambda r: r.component):
        by.setdefault(r.vec_id, []).append(r)
    return by


def compare(df, rows, most=32):
    ids, n, deviation, whitened, explained = brute(rows, most)
    by = matrix(df)
    assert set(by) == set(ids)
    sign = np.sign(np.sum([[r.whitened for r in by[i][:most]] * w for i, w in zip(ids, whitened, strict=True)], axis=0))
    for i, d, w in zip(ids, deviation, whitened, strict=True):
        mine = by[i][:most]
        assert [r.component for r in mine] == list(range(1, len(explained) + 1))
        assert {(r.n, r.deviation) for r in mine} == {(n, d)}
        assert np.allclose([r.whitened for r in mine], sign * w, rtol=1e-7, atol=1e-7)
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-9)
        assert max(r.identity_error for r in mine) < 1e-9


@given(st.integers(1, 9), st.integers(1, 12), st.integers(0, 2 ** 32), st.floats(0, 6))
@settings(max_examples=150, deadline=None)
def test_eigenvalues_against_numpy(d, n, seed, spread):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * 10.0 ** rng.uniform(-spread / 2, spread / 2, size=d)
    v = x.T @ x / n
    values, axes = whitening.components(v)
    want = np.linalg.eigvalsh(v)[::-1]
    assert len(values) <= min(n, d)
    assert np.allclose(values, want[:len(values)], rtol=1e-9, atol=1e-14 * want[0])
    assert np.all(want[len(values):] <= 1e-12 * want[0])
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-12)
    assert np.allclose(v @ axes, axes * values, atol=1e-12 * want[0])


def test_cholesky_takes_the_largest_first():
    v = np.diag([1.0, 9.0, 4.0])
    factor, order = whitening.pivoted_cholesky(v)
    assert order.tolist() == [1, 2, 0] and np.allclose(factor, np.diag([3.0, 2.0, 1.0]))
    factor, order = whitening.pivoted_cholesky(np.ones((4, 4)))
    assert factor.shape == (4, 1)


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(5, 5))
    rows = [(i, [float(c) for c in (rng.normal(size=5) @ mix + 3).astype("f4")]) for i in range(200)]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5),
           (904, [1.0, 2.0]), (905, [])]
    out = whitening.whiten(table(spark, rows + odd).repartition(7))
    compare(out, rows)
    few = whitening.whiten(table(spark, rows), most=2)
    compare(few, rows, most=2)
    assert few.count() == 400


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i // 2, [float(c) for c in v]) for i, v in enumerate(np.repeat(rng.normal(size=(30, 3)), 2, axis=0))]
    rows += [(None, [0.5, -0.5, 2.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 3 * len(rows) and {r.n for r in got} == {61}
    assert sum(r.vec_id is None for r in got) == 3
    ids, n, deviation, whitened, explained = brute(rows)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]])
def test_no_components_no_rows(spark, rows):
    out = whitening.whiten(table(spark, rows))
    assert out.schema == whitening.OUT and out.count() == 0


def test_fewer_components_than_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, -1.0 * i, 7.0]) for i in range(50)]  # rank 1
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9
    assert max(r.identity_error for r in got) < 1e-9


def test_equal_eigenvalues(spark):
    rows = [(4 * i + j, [float(a), float(b)]) for i in range(5) for j, (a, b) in enumerate([(3, 0), (-3, 0), (0, 3), (0, -3)])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and np.allclose([r.explained for r in got], 0.5)
    assert max(r.identity_error for r in got) < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [1e9, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 5.0])] * 3
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} and {r.n for r in got} == {9}
    x = np.array([[5, 6], [7, 9]], dtype=np.int64)
    big = np.array([[1 << 40, 0], [0, 1 << 20]], dtype=np.int64)
    for m in (x, big):
        n, sums = 3, [int(t) for t in m.sum(axis=0)]
        want = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in m]
        assert whitening._deviation(m, n, sums) == [w if w <= whitening.LONG else None for w in want]


def test_entries_beyond_a_long_take_no_part(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(30)]
    compare(whitening.whiten(table(spark, rows + [(99, [3e38, 0.0])])), rows)


def test_op13_whole_table(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(queries.op13_embedding_whitening(spark, sf), rows)
