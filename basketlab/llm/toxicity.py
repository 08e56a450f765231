"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the bag has a label. A sentence's
chance of being toxic is a logistic function of the words in it, and a
document's is the noisy-or of its sentences: 1 - prod(1 - p). Training
minimises the log loss of the documents, so the gradient of a toxic document
flows to the sentences that explain its label, and the sentence scores say
where a document offends.

Features are distinct words and distinct beginnings of words; the L1 penalty
leaves those that matter. The model is a table of weights, fitted in one task
on a bounded sample of the labelled documents and sent to the scoring tasks.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .quality import held_out

_SENTENCE = re.compile(r"[^.!?\n。！？]+")
_WORD = re.compile(r"\w+")
#: Words in an instance; longer sentences are cut.
MOST_WORDS = 40
#: Characters of a word's beginnings (words of that length and less have none).
HEADS = (4, 5, 6)
MODEL = T.StructType([
    T.StructField("feature", T.ArrayType(T.StringType())), T.StructField("weight", T.ArrayType(T.DoubleType())),
    T.StructField("bias", T.DoubleType()), T.StructField("n0", T.LongType()), T.StructField("n1", T.LongType())])
LOCATED = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                        T.StructField("score", T.DoubleType())])


def lowered(text: str) -> str:
    """Lower case, each character in its place."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return low


def instances(text: str):
    """(start, end, words) of the sentences that hold a word, cut after
    ``MOST_WORDS`` words."""
    low = lowered(text)
    for m in _SENTENCE.finditer(low):
        words = _WORD.findall(m.group())
        if len(words) <= MOST_WORDS:
            if words:
                yield m.start(), m.end(), words
            continue
        at = list(_WORD.finditer(low, m.start(), m.end()))
        for i in range(0, len(at), MOST_WORDS):
            some = at[i:i + MOST_WORDS]
            yield some[0].start(), some[-1].end(), [x.group() for x in some]


def features(words: list[str]) -> set[str]:
    """Distinct words, and distinct beginnings (marked by a space)."""
    return {*words, *(w[:n] + " " for w in words for n in HEADS if len(w) > n)}


def softplus(z):
    import numpy as np
    return np.logaddexp(0.0, z)


def noisy_or(z, bag, bags: int):
    """Per bag log prod(1 - p), for sentences with the log-odds ``z``."""
    import numpy as np
    return -np.bincount(bag, softplus(z), minlength=bags)


def log_loss(z, bag, label):
    """Mean log loss of the bags."""
    import numpy as np
    miss = np.minimum(noisy_or(z, bag, len(label)), -1e-12)
    return float(-np.where(label == 1, np.log(-np.expm1(miss)), miss).mean())


def slopes(z, bag, label):
    """Derivative of ``log_loss`` by each sentence's log-odds: p for a clean
    document, -p q / (1 - q) with q = prod(1 - p) for a toxic one."""
    import numpy as np
    p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    share = 1 / np.expm1(-np.minimum(noisy_or(z, bag, len(label)), -1e-12))
    return np.where(label[bag] == 1, -p * share[bag], p) / len(label)


def fit(rows, offsets, bag, label, width: int, *, rounds: int = 300, rate: float = 0.5, penalty: float = 1e-4):
    """Weights and bias. Instance i has the features
    ``rows[offsets[i]:offsets[i + 1]]`` and lies in ``bag[i]``; ``label`` is 0
    or 1 a bag. Proximal gradient steps on the mean log loss plus
    penalty * |weights|, each coordinate with its own falling rate."""
    import numpy as np
    n = len(label)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    w, b = np.zeros(width), -math.log(max(1.0, len(bag) / max(1, n))) - 1.0
    seen_w, seen_b = np.full(width, 1e-12), 1e-12
    for _ in range(rounds):
        z = np.bincount(of, w[rows], minlength=len(bag)) + b
        g = slopes(z, bag, label)
        grad = np.bincount(rows, g[of], minlength=width)
        total = float(g.sum())
        seen_w += grad * grad
        seen_b += total * total
        step = rate / np.sqrt(seen_w)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        b -= rate / math.sqrt(seen_b) * total
    return w, b


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    #: Added to a document's log-odds: from the sample's share of label 1 to the labels'.
    shift: float = 0.0
    #: Every document's score, if there was nothing to learn from.
    share: float | None = None

    def sentence(self, words: list[str]) -> float:
        """Log-odds of a sentence."""
        get = self.weights.get
        return self.bias + math.fsum(filter(None, map(get, features(words))))

    def document(self, odds: list[float]) -> float:
        """The score from the sentences' log-odds: their noisy-or, moved to
        the labels' own share. A text without words is one empty sentence."""
        if self.share is not None:
            return self.share
        miss = -math.fsum(max(z, 0.0) + math.log1p(math.exp(-abs(z))) for z in odds or [self.bias])
        logit = math.log(-math.expm1(miss)) - miss if miss < 0 else -745.0
        z = logit + self.shift
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _sample(docs: DataFrame, labels: DataFrame, per_label: int, chars: int) -> DataFrame:
    """doc_id, text, label of the labelled documents with the smallest hashed
    ids, as many a label as allowed by both bounds."""
    from functools import reduce

    from pyspark.sql import Window
    once = (labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
            .groupBy("doc_id").agg(F.min("label").alias("label")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = reduce(DataFrame.unionByName,
                    [once.filter(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)])
    texts = docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    running = F.sum(F.length("text")).over(Window.partitionBy("label").orderBy(*order))
    # The window holds at most per_label rows a label.
    return texts.withColumn("running", running).filter(F.col("running") <= chars).drop("running")


def train(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", per_label: int = 4000,
          chars_per_label: int = 16_000_000, least_docs: int = 2, **options) -> Model:
    """Learn from ``labels`` (doc_id, label 0 or 1; repeated ids count once,
    with the smaller label; a repeated document id is one document).

    The sample is bounded: of each label the ``per_label`` documents with the
    smallest hashed ids, as long as their texts add up to at most
    ``chars_per_label`` characters. Whole texts are read. Features of fewer than
    ``least_docs`` sample documents are left out. If a label has no documents,
    every text gets the other's smoothed share as its score.
    """
    spark = docs.sparkSession
    common.python_ready(spark)
    once = labels.filter("label IN (0, 1)")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))

    def run(table):
        import numpy as np
        import pyarrow as pa
        table = table.sort_by("doc_id")  # the same sum, whatever the order of arrival
        label = np.array(table.column("label").to_pylist(), dtype=np.int64)
        place: dict[str, int] = {}
        in_docs, ids, counts, bag = [], [], [], []
        for d, text in enumerate(table.column("text")):
            seen = set()
            for _, _, words in [*instances(text.as_py())] or [(0, 0, [])]:
                some = [place.setdefault(f, len(place)) for f in sorted(features(words))]
                seen.update(some)
                ids.extend(some)
                counts.append(len(some))
                bag.append(d)
            in_docs.extend(seen)
        held = np.bincount(np.array(in_docs, dtype=np.int64), minlength=len(place)) >= least_docs
        ids, offsets = np.array(ids, dtype=np.int64), np.append(0, np.cumsum(np.array(counts, dtype=np.int64)))
        keep = held[ids] if len(ids) else np.zeros(0, dtype=bool)
        offsets = np.append(0, np.cumsum(keep))[offsets]
        new = np.cumsum(held) - 1
        names = [f for f, i in place.items() if held[i]]
        w, b = fit(new[ids[keep]] if len(ids) else ids, offsets, np.array(bag, dtype=np.int64), label,
                   max(1, len(names)), **options)
        used = np.flatnonzero(w[:len(names)])
        n1 = int(label.sum())
        return pa.table([pa.array([v], f) for v, f in (
            ([names[i] for i in used], pa.list_(pa.string())), (w[used], pa.list_(pa.float64())),
            (float(b), pa.float64()), (len(label) - n1, pa.int64()), (n1, pa.int64()))], names=MODEL.names)

    sample = _sample(rows, once.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")),
                     per_label, chars_per_label)
    total = once.agg(F.count("*").alias("n"), F.sum("label").alias("n1")).first()
    prior = _odds(total["n1"] or 0, total["n"])
    found = sample.groupBy(F.lit(0).alias("one")).applyInArrow(run, MODEL).first()
    if found is None or not found["n0"] or not found["n1"]:
        return Model({}, prior, 0.0, _chance(prior))
    shift = prior - _odds(found["n1"], found["n0"] + found["n1"])
    return Model(dict(zip(found["feature"], found["weight"], strict=True)), found["bias"], shift)


def _odds(ones: int, n: int) -> float:
    """Smoothed log-odds of label 1."""
    return math.log((ones + 1) / (n - ones + 1))


def _judged(text: str, model: Model):
    found = [(start, end, model.sentence(words)) for start, end, words in instances(text)]
    return model.document([z for _, _, z in found]), found


def _chance(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def locate(docs: DataFrame, model: Model, *, id_col="doc_id", text_col="text", least: float = 0.5) -> DataFrame:
    """Per document: doc_id, score and ``offending``, the sentences whose own
    chance is at least ``least``: (start, end, score) in order, positions in
    code points, end exclusive. Null texts are empty and have none; null ids
    stay null, repeated rows are judged each, an empty table gives no rows,
    other columns play no part."""
    return _scored(docs, model, id_col, text_col, least).select("doc_id", "score", "offending")


def _scored(docs: DataFrame, model: Model, id_col: str, text_col: str, least: float) -> DataFrame:
    common.python_ready(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()),
                           T.StructField("offending", T.ArrayType(LOCATED)), T.StructField("worst", LOCATED),
                           T.StructField("n_sentences", T.LongType())])

    def run(batches):
        import pyarrow as pa
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        for batch in batches:
            scores, spans, worst, sizes = [], [], [], []
            for text in batch.column(1):
                score, found = _judged(text.as_py(), model)
                found = [{"start": s, "end": e, "score": _chance(z)} for s, e, z in found]
                scores.append(score)
                sizes.append(len(found))
                spans.append([x for x in found if x["score"] >= least])
                worst.append(max(found, key=lambda x: (x["score"], -x["start"]), default=None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span)),
                 pa.array(worst, span), pa.array(sizes, pa.int64())], names=schema.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       common.text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, *, id_col="doc_id", text_col="text", least: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1, higher: label 1 is
    likelier), predicted (1 if score >= ``least``), n_sentences, n_offending,
    and worst_start and worst_end of the likeliest sentence (the first of
    equals; null without one). Null and empty texts, and texts without words,
    are scored as one empty sentence; null ids stay null, repeated rows are
    scored each, an empty table gives no rows, very long texts are read to
    their end, other columns play no part."""
    out = _scored(docs, model, id_col, text_col, least)
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"), "n_sentences",
                      F.size("offending").cast("long").alias("n_offending"),
                      F.col("worst.start").alias("worst_start"), F.col("worst.end").alias("worst_end"))
