"""Quality classifier by compression with zstandard dictionaries.

One dictionary is trained on good and one on bad labelled text. A document is
cut into pieces of equal length, and each piece is compressed with both, so
that the dictionaries and not the document's own past decide. With g and b the
summed sizes, the normalised difference (b - g) / (b + g) says which
vocabulary fits; a logistic curve turns it, with the log of g over the text's
length (which places repetitive text), into a probability. The curve is fitted
on labelled documents that the dictionaries haven't seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

LEVEL = 3
FEATURES = T.StructType([T.StructField("difference", T.DoubleType()), T.StructField("density", T.DoubleType())])


def held_out(id_col: str = "doc_id") -> Column:
    """The documents whose labels are never learnt from. A null id is not one
    of them (and has no label)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    good: bytes
    bad: bytes
    piece: int
    #: Intercept, weight of the difference, weight of the density.
    weights: tuple[float, float, float]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; from too little text, the text itself."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressors(good: bytes, bad: bytes):
    import zstandard
    return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                                     write_content_size=False, write_dict_id=False) if d
            else zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
            for d in (good, bad)]


def _features(text: str, compressors, piece: int) -> tuple[float, float]:
    data = text.encode()
    g = b = 0
    for i in range(0, max(1, len(data)), piece):
        part = data[i:i + piece]
        g += len(compressors[0].compress(part))
        b += len(compressors[1].compress(part))
    return (b - g) / (b + g), math.log((g + 1) / (len(data) + 1))


def _logistic(x, y, ridge: float = 1e-3):
    """Weights of a logistic regression by Newton steps, features unscaled."""
    import numpy as np
    x, y = np.asarray(x, dtype=float).reshape(-1, 2), np.asarray(y, dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(3),
                               a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slope = w[1:] / scale
    return float(w[0] - slope @ mean), float(slope[0]), float(slope[1])


def _sample(labels: DataFrame, per_label: int) -> DataFrame:
    """doc_id, label, place: the labelled ids with the smallest hashes."""
    once = (labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
            .groupBy("doc_id").agg(F.min("label").alias("label")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return reduce(DataFrame.unionByName,
                  [once.filter(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)])


def _pieces(docs: DataFrame, piece: int, most: int) -> DataFrame:
    """doc_id, at, part: the texts in UTF-8 in pieces; of more than ``most``
    pieces those with the smallest hashes of id and place."""
    data = docs.select("doc_id", F.encode("text", "UTF-8").alias("data")).filter(F.octet_length("data") > 0)
    last = F.floor((F.octet_length("data") - 1) / piece).cast("int")
    parts = data.select("doc_id", "data", F.explode(F.sequence(F.lit(0), last)).alias("at")).select(
        "doc_id", "at", F.substring("data", F.col("at") * piece + 1, F.lit(piece)).alias("part"))
    return parts.orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at").limit(most)


def _dictionaries(pieces: dict[int, DataFrame], size: int) -> dict[int, bytes]:
    """Each label's dictionary, trained on its pieces in the order of id and
    place. A task trains it: of the sample the driver gets ``size`` bytes a label."""
    make = _dictionary

    def run(group):
        import pyarrow as pa
        group = group.sort_by([("doc_id", "ascending"), ("at", "ascending")])
        data = make(group.column("part").to_pylist(), size)
        return pa.table({"label": group.column("label").slice(0, 1), "data": pa.array([data], pa.binary())})

    rows = [df.withColumn("label", F.lit(k)) for k, df in pieces.items()]
    made = reduce(DataFrame.unionByName, rows).groupBy("label").applyInArrow(run, "label int, data binary")
    return dict.fromkeys(pieces, b"") | {r.label: bytes(r.data) for r in made.collect()}


def train(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", dictionary_rows: int = 1500,
          calibration_rows: int = 2000, sample_chars: int = 32_768, dictionary_bytes: int = 65_536,
          piece: int = 1024) -> Model:
    """Learn from ``labels`` (doc_id, label 0 or 1; repeated ids count once,
    with the smaller label).

    The sample is bounded: of each label, the ``dictionary_rows`` documents
    with the smallest hashed ids give their pieces to its dictionary (trained
    in a task), from anywhere in their texts and by a hash, up to
    ``sample_chars`` bytes a document asked for; the next
    ``calibration_rows``, with their whole texts, fit the curve (their two
    features are). If a label has no documents, the score is the share of the
    other, evened out, for every text.
    """
    spark = docs.sparkSession
    common.python_ready(spark)
    chosen = common.materialise(_sample(labels, dictionary_rows + calibration_rows), "sample")
    chosen_docs = common.materialise(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
        .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "sample_texts")
    place = {}
    for label in (0, 1):
        ids = [r[0] for r in chosen_docs.filter(F.col("label") == label)
               .orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
        # With fewer documents than asked for, half go to either use.
        half = min(dictionary_rows, (len(ids) + 1) // 2)
        place[label] = set(ids[:half])
    seen = place[0] | place[1]
    if not place[0] or not place[1]:
        n = {k: chosen_docs.filter(F.col("label") == k).count() for k in (0, 1)}
        p = (n[1] + 1) / (n[0] + n[1] + 2)
        return Model(b"", b"", piece, (math.log(p / (1 - p)), 0.0, 0.0))
    made = _dictionaries({k: _pieces(chosen_docs.filter(F.col("doc_id").isin(sorted(place[k]))), piece,
                                     dictionary_rows * sample_chars // piece) for k in (0, 1)}, dictionary_bytes)
    model = Model(made[1], made[0], piece, (0, 0, 0))
    rows = (features(chosen_docs.select("doc_id", "label", "text"), model, ["doc_id", "label"])
            .select("doc_id", "label", "difference", "density").collect())
    # Both labels in their own proportions again, so that the curve is calibrated.
    share = labels.filter("label IN (0, 1)").agg(F.avg("label")).first()[0]
    rest = sorted(r for r in rows if r.doc_id not in seen) or rows
    weights = calibrate([(r.difference, r.density) for r in rest], [r.label for r in rest], share)
    return Model(model.good, model.bad, piece, weights)


def calibrate(x, y, share: float) -> tuple[float, float, float]:
    """Logistic weights, the intercept moved from the sample's share of label
    1 to ``share``."""
    w = _logistic(x, y)
    p = (sum(y) + 1) / (len(y) + 2)
    share = min(max(share, 1e-6), 1 - 1e-6)
    return w[0] + math.log(share / (1 - share)) - math.log(p / (1 - p)), w[1], w[2]


def features(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` and the two features of its text."""
    schema = T.StructType([*(docs.schema[c] for c in keep), *FEATURES.fields])
    good, bad, piece = model.good, model.bad, model.piece

    def run(batches):
        import pyarrow as pa
        compressors = _compressors(good, bad)
        for batch in batches:
            rows = [_features(t or "", compressors, piece) for t in batch.column(text_col).to_pylist()]
            columns = [batch.column(c) for c in keep]
            columns += [pa.array([r[i] for r in rows], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, schema)


def _probability(model: Model) -> Column:
    z = F.lit(model.weights[0]) + sum(F.col(c) * w for c, w in zip(FEATURES.names, model.weights[1:], strict=True))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), z))))


def accepted(docs: DataFrame, model: Model, *, text_col="text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, as they are, whose score is at least ``least``."""
    common.python_ready(docs.sparkSession)
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    return features(row, model, ["row"]).filter(_probability(model) >= least).select("row.*")


def score(docs: DataFrame, model: Model, *, id_col="doc_id", text_col="text", least: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1, higher: label 1 is
    likelier) and predicted (1 if score >= ``least``). Null texts are empty
    and are scored too, null ids stay null, repeated rows are scored each, an
    empty table gives no rows, other columns play no part."""
    common.python_ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    out = features(rows, model, ["doc_id"]).withColumn("score", _probability(model))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"))
