import hashlib
import random

import numpy as np
import pytest
from llm_helpers import docs_df, sf  # noqa: F401

from basketlab.llm import queries, repeats


def brute(rows, length):
    """Every string of ``length`` bytes, in the order of the documents."""
    seen, out = set(), []
    for d, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1:])


def test_identifiers_are_of_the_content():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 3, 400).astype(np.uint8)
    for q in (1, 2, 5, 7, 25):
        h = repeats.gram_buckets(data, q)
        assert len(h) == 400 - q + 1
        by = {}
        for p, x in enumerate(h):
            assert by.setdefault(int(x), data[p:p + q].tobytes()) == data[p:p + q].tobytes()
        assert len(by) == len({data[p:p + q].tobytes() for p in range(len(h))})


def test_blocks_cover_every_string(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 64)
    data = np.random.default_rng(1).integers(0, 2, 700).astype(np.uint8)
    _, _, start, n = repeats.blocks_of(data, 21)
    assert np.concatenate([np.arange(s, s + k) for s, k in zip(start, n, strict=True)]).tolist() == list(range(680))
    assert n.max() < 1024


def corpus(rng):
    words = ["alpha", "beta", "gamma", "delta", "é", "ñandú", "of", "the", "in"]
    make = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "ing"]) for _ in range(n))
    passage = make(12)
    texts = []
    for i in range(120):
        t = make(rng.choice([0, 3, 20, 60]))
        if rng.random() < 0.4:
            t += passage[rng.randint(0, 10):rng.randint(30, 90)] + make(3)
        if texts and rng.random() < 0.3:
            old = rng.choice(texts)
            cut = rng.randint(0, len(old))
            t = old[:cut] + rng.choice(["", "X"]) + old[cut:] + t
        texts.append(t)
    return texts + ["ab" * 300, "a" * 500, "a" * 19, "a" * 20, "", None, texts[5], texts[5], passage * 8]


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    for length in (20, 23):
        rows = list(enumerate(corpus(rng)))
        shuffled = rng.sample(rows, len(rows))
        got = sorted((tuple(r) for r in repeats.removed(docs_df(spark, shuffled), length).collect()), key=key)
        assert got == sorted(brute(rows, length), key=key)


def test_small_parts_give_the_same(spark, monkeypatch):
    rows = list(enumerate(corpus(random.Random(11))))
    monkeypatch.setattr(repeats, "CHUNK", 50)
    held = []
    for _, t in rows:
        data = np.frombuffer((t or "").encode(), dtype=np.uint8)
        if len(data) >= 20:
            held.append(repeats.blocks_of(data, 20))
    assert held


def test_texts_beyond_a_chunk(spark):
    """More than a mebibyte: copies over the border of two chunks, and whole."""
    rng = np.random.default_rng(8)
    long = rng.integers(97, 123, 1_300_000, dtype=np.uint8).tobytes().decode()
    edge = repeats.CHUNK
    rows = [(1, long), (2, "new " + long[edge - 150:edge + 170] + " end"), (3, long[900_000:] + "x" + long[:50_000])]
    got = sorted((tuple(r) for r in repeats.removed(docs_df(spark, rows), 100).collect()), key=key)
    assert got == sorted(brute(rows, 100), key=key)


def test_length_has_bounds(spark):
    for length in (3, repeats.LONGEST + 1, 3000):
        with pytest.raises(ValueError):
            repeats.removed(docs_df(spark, [(1, "x")]), length)
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh") for _ in range(4000))
    rows = [(1, passage), (2, "q" + passage[1000:3500])]
    got = sorted((tuple(r) for r in repeats.removed(docs_df(spark, rows), repeats.LONGEST).collect()), key=key)
    assert got == sorted(brute(rows, repeats.LONGEST), key=key)


def test_null_and_repeated_ids(spark):
    t = "one string that is long enough to be found again"
    rows = [(None, t), (5, t), (5, t), (5, "other"), (3, None), (9, t + t)]
    out = [tuple(r)[:4] for r in repeats.removed(docs_df(spark, rows), 20).collect()]
    assert sorted(out, key=lambda r: (r[0] or 0, r[1:])) == [
        (None, 48, 0, 0), (3, 0, 0, 0), (5, 5, 0, 0), (5, 48, 48, 1), (5, 48, 48, 1), (9, 96, 96, 1)]
    assert repeats.removed(docs_df(spark, []), 20).count() == 0
    r = repeats.removed(docs_df(spark, rows[1:2] + [(6, "x" + t)]), 20, with_text=True).collect()
    assert {x.doc_id: bytes(x.kept) for x in r} == {5: t.encode(), 6: b"x"}


def test_op9_whole_table(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = sorted((tuple(r) for r in queries.op9_repeated_bytes(spark, sf).collect()), key=key)
    assert got == sorted(brute(rows, 100), key=key)
