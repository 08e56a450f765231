import numpy as np
import pytest

from basketlab.llm import queries, vptree


def brute(rows, k, ask):
    ok = [(i, np.array(v, dtype="f4").astype("f8")) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v))]
    out = []
    for q, x in dict(reversed([r for r in ok if ask(r[0])])).items():
        best = sorted((-float((x * y).sum()), i) for i, y in ok if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


SCHEMA = "vec_id long, embedding array<float>, rank int, score string, shard int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 9) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("seed", [0, 1])
def test_factor_one_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype("f4") * rng.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(80)]  # one common vector: ties to the smaller id
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None] + [0.0] * 4), (2003, [float("nan")] * 6),
             (2004, [float("inf")] * 6), (None, [1.0] * 6), (2005, [1.0, 2.0]), (2006, [])]
    rows += [rows[20], rows[20]]  # repeated rows
    df = table(spark, rows)
    ask = lambda i: i % 10 == 0
    out = vptree.nearest(df, df.filter("vec_id % 10 = 0"), 20, factor=1.0, shard_rows=90, block_rows=7, leaf=8)
    want = brute([r for r in rows if r[0] not in (2005, 2006)], 20, ask)
    assert [(q, r, i) for q, r, i, _ in got(out)] == [(q, r, i) for q, r, i, _ in want]
    assert np.allclose([x[3] for x in got(out)], [x[3] for x in want], rtol=0, atol=1e-12)


def test_ties_of_different_vectors(spark):
    """Signs only: thousands of vectors share a score."""
    rng = np.random.default_rng(4)
    v = np.unique(rng.choice([-1.0, 1.0], size=(4000, 12)), axis=0)
    rng.shuffle(v)
    rows = [(int(i), [float(x) for x in row]) for i, row in enumerate(v)]
    assert len(rows) > 2500
    df = table(spark, rows)
    out = vptree.nearest(df, df.filter("vec_id % 20 = 0"), 20)  # default parameters
    x = v.astype("f8")
    want = []
    for q in range(0, len(v), 20):
        score = x @ x[q]
        order = [int(i) for i in np.lexsort((np.arange(len(v)), -score)) if i != q][:20]
        want += [(q, rank, i, float(score[i])) for rank, i in enumerate(order, 1)]
    assert got(out) == sorted(want)


def test_clustered_vectors_are_searched_near_them(spark):
    """Exact, and most (query, shard) pairs are never sent."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16)) * 10
    v = (centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 16)) * 0.3).astype("f4")
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    df = table(spark, rows)
    out = vptree.nearest(df, df.filter("vec_id % 20 = 0"), 20, shard_rows=100, block_rows=50, leaf=16)
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert [(q, r, i) for q, r, i, _ in got(out)] == [(q, r, i) for q, r, i, _ in want]
    valid = vptree.valid(df, "vec_id", "embedding")
    _, cells = vptree.cells_of(valid, 100)
    x = v.astype("f8")
    kth = np.sort(x[::20] @ x.T, axis=1)[:, -21]
    sent = sum(len(cells.shards_of(c)) for c in cells.open(x[::20], kth, 1.0))
    assert sent < 0.3 * 300 * int(cells.shards.sum())


def test_few_candidates_and_no_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])]
    df = table(spark, rows)
    assert got(vptree.nearest(df, df.filter("vec_id % 20 = 0"))) == brute(rows, 20, lambda i: i % 20 == 0)
    empty = table(spark, [])
    assert vptree.nearest(empty, empty).count() == 0
    assert vptree.nearest(df, empty).count() == 0


def test_op3_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = got(queries.op3_vantage_point(spark, sf))
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert len(out) == len(want)
    hits = {(q, i) for q, _, i, _ in out} & {(q, i) for q, _, i, _ in want}
    assert len(hits) >= 0.9 * len(want)
    score = {(q, i): s for q, _, i, s in want}
    assert all(abs(score[q, i] - s) < 1e-12 for q, _, i, s in out if (q, i) in score)


@pytest.mark.parametrize("spread", [0.1, 0.3])
def test_recall_on_full_shards_with_unequal_norms(spark, tmp_path, spread):
    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = np.random.default_rng(3)
    n = 16384
    v = rng.normal(size=(n, 64))
    v *= (np.exp(spread * rng.normal(size=n)) / np.linalg.norm(v, axis=1))[:, None]
    v = v.astype("f4")
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(v), pa.list_(pa.float32()))}),
                   tmp_path / "v.parquet")
    df = spark.read.parquet(str(tmp_path / "v.parquet"))
    out = got(vptree.nearest(df, df.filter("vec_id % 64 = 0"), 20))  # default factor and shards
    x = v.astype("f8")
    scores = x[::64] @ x.T
    scores[np.arange(len(scores)), np.arange(0, n, 64)] = -np.inf
    want = {(64 * q, int(i)) for q, row in enumerate(np.argsort(-scores, axis=1)[:, :20]) for i in row}
    assert len(out) == len(want)
    assert {(q, i) for q, _, i, _ in out} == want
