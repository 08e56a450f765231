import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs_df, sf  # noqa: F401

from basketlab.llm import queries, toxicity

CLEAN = ["the garden is green", "we walk along the river", "bread and butter", "a quiet morning in town",
         "numbers are added here", "she reads a long book"]


def corpus(n, seed=0, most=9):
    """Documents of clean sentences; every third has one with a bad word."""
    rng = np.random.default_rng(seed)
    rows, labels, where = [], [], {}
    for i in range(n):
        parts = [CLEAN[k] for k in rng.integers(0, len(CLEAN), rng.integers(1, most))]
        toxic = i % 3 == 0
        if toxic:
            k = int(rng.integers(0, len(parts) + 1))
            parts.insert(k, f"you {rng.choice(['grobian', 'dolt'])} there")
            where[i] = k
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, int(toxic)))
    return rows, labels, where


def label_df(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, label int")


def brute_score(text, model):
    """From the definition: 1 - prod(1 - p), moved by the shift."""
    low, chances = text.lower(), []
    for sentence in re.split(r"[.!?\n。！？]+", low):
        words = re.findall(r"\w+", sentence)
        for i in range(0, len(words), toxicity.MOST_WORDS):
            some = words[i:i + toxicity.MOST_WORDS]
            names = set(some) | {w[:n] + " " for w in some for n in toxicity.HEADS if len(w) > n}
            chances.append(1 / (1 + math.exp(-model.bias - sum(model.weights.get(f, 0.0) for f in names))))
    p = 1 - math.prod(1 - c for c in chances or [1 / (1 + math.exp(-model.bias))])
    odds = p / (1 - p) * math.exp(model.shift) if p < 1 else math.inf
    return odds / (1 + odds) if odds < math.inf else 1.0


@given(st.text(alphabet=st.sampled_from("abİß .!?\n,é。'1"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_sentences_lie_in_the_text(text):
    found = list(toxicity.instances(text))
    assert len(toxicity.lowered(text)) == len(text)
    for start, end, words in found:
        assert 0 <= start < end <= len(text) and words
        assert re.findall(r"\w+", toxicity.lowered(text)[start:end]) == words
    assert [w for _, _, x in found for w in x] == re.findall(r"\w+", toxicity.lowered(text))


def test_long_sentences_are_cut():
    text = " ".join(f"w{i}" for i in range(100))
    found = list(toxicity.instances(text))
    assert [len(w) for _, _, w in found] == [40, 40, 20] and text[found[1][0]:].startswith("w40")


@pytest.mark.parametrize("seed", range(4))
def test_slopes_are_the_losss_derivative(seed):
    rng = np.random.default_rng(seed)
    bag = np.sort(rng.integers(0, 6, 25))
    bag = np.append(bag, np.arange(6))
    label, z = rng.integers(0, 2, 6), rng.normal(size=len(bag)) * 3
    g, e = toxicity.slopes(z, bag, label), 1e-6
    for i in range(len(z)):
        up, down = z.copy(), z.copy()
        up[i], down[i] = z[i] + e, z[i] - e
        want = (toxicity.log_loss(up, bag, label) - toxicity.log_loss(down, bag, label)) / (2 * e)
        assert np.isclose(g[i], want, rtol=1e-4, atol=1e-7)


def test_fit_lowers_the_loss_and_finds_the_feature():
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 60)
    bag = np.repeat(np.arange(60), 4)
    # Feature 0 is in one sentence of each toxic document; features 1 to 9 anywhere.
    rows = [[int(rng.integers(1, 10))] for _ in bag]
    for d in np.flatnonzero(label):
        rows[4 * d + int(rng.integers(0, 4))].append(0)
    offsets = np.append(0, np.cumsum([len(r) for r in rows]))
    w, b = toxicity.fit(np.concatenate(rows), offsets, bag, label, 10)
    z = np.array([b + sum(w[f] for f in r) for r in rows])
    assert toxicity.log_loss(z, bag, label) < 0.2 < toxicity.log_loss(np.zeros(len(bag)), bag, label)
    assert np.argmax(w) == 0 and w[0] > 3 and np.abs(w[1:]).max() < w[0] / 2


def test_offending_sentences_are_located(spark):
    rows, labels, _ = corpus(240)
    docs = docs_df(spark, rows)
    model = toxicity.train(docs, label_df(spark, labels))
    unseen, truth, where = corpus(90, seed=7)
    got = {r.doc_id: r for r in toxicity.locate(docs_df(spark, unseen), model).collect()}
    for (i, text), (_, toxic) in zip(unseen, truth, strict=True):
        spans = [text[x.start:x.end] for x in got[i].offending]
        assert (got[i].score >= 0.5) == bool(toxic)
        assert len(spans) == toxic and all("grobian" in s or "dolt" in s for s in spans)
        if toxic:
            assert text[:got[i].offending[0].start].count(".") == where[i]
    out = {r.doc_id: r for r in toxicity.score(docs_df(spark, unseen), model).collect()}
    for i, text in unseen:
        assert math.isclose(out[i].score, brute_score(text, model), rel_tol=1e-9, abs_tol=1e-12)
        assert (out[i].n_offending, out[i].predicted) == (len(got[i].offending), int(out[i].score >= 0.5))
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_odd_rows(spark):
    rows, labels, _ = corpus(60)
    model = toxicity.train(docs_df(spark, [*rows, rows[0], (None, "dolt"), (900, None)]),
                           label_df(spark, [*labels, (0, 1), (900, 0), (901, 1), (3, None), (4, 7), (None, 1)]))
    long = "the garden is green. " * 60_000 + "you dolt there."
    odd = [(1, None), (2, ""), (3, "  \n.!?"), (None, "you dolt there"), (4, long), (5, "you dolt there"),
           (5, "you dolt there"), (6, "x" * 100_000)]
    df = docs_df(spark, odd).selectExpr("*", "3 as score", "true as held_out", "5 as label")
    got = sorted(toxicity.score(df, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 5, 6, None]
    blank = [r for r in got if r.doc_id in (1, 2, 3)]
    assert len({r.score for r in blank}) == 1 and blank[0].predicted == 0
    assert {(r.n_sentences, r.n_offending, r.worst_start) for r in blank} == {(0, 0, None)}
    assert [r.predicted for r in got[3:]] == [1, 1, 1, 0, 1] and got[-1].held_out is False
    assert got[3].n_sentences == 60_001 and long[got[3].worst_start:].strip() == "you dolt there."
    assert got[4] == got[5]
    assert toxicity.score(docs_df(spark, []), model).count() == 0


def test_a_label_without_documents(spark):
    rows, _, _ = corpus(12)
    for labels, low, high in (([], 0.49, 0.51), ([(0, 0), (1, 0)], 0, 0.3), ([(0, 1), (1, 1)], 0.7, 1)):
        model = toxicity.train(docs_df(spark, rows), label_df(spark, labels))
        assert all(low < r.score < high for r in toxicity.score(docs_df(spark, rows[:1]), model).collect())
    assert toxicity.train(docs_df(spark, []), label_df(spark, [(1, 1)])).weights == {}


def test_sample_is_bounded(spark):
    rows, labels, _ = corpus(90)
    docs, labels = docs_df(spark, rows).select("doc_id", "text"), label_df(spark, labels)
    few = toxicity._sample(docs, labels, 7, 10 ** 9).collect()
    assert sorted(r.label for r in few) == [0] * 7 + [1] * 7
    small = toxicity._sample(docs, labels, 1000, 400).collect()
    for k in (0, 1):
        assert 0 < sum(len(r.text) for r in small if r.label == k) <= 400


def test_held_out_documents(spark):
    big = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    rows = queries.op12_toxicity(spark, big).collect()
    assert len(rows) == spark.read.parquet(f"{big}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 500
    caught = [p for p, y in held if y]
    false = [p for p, y in held if not y]
    assert sum(caught) >= 0.8 * len(caught) and sum(false) <= 0.02 * len(false)
