"""A training corpus from ``documents``: five stages, each a table.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
function's ``docs``. All but the last return the columns of ``documents``.

quality          documents that the compression classifier rejects go
near_duplicates  of each group of near copies the smallest id stays
decontamination  documents that hold a benchmark passage go
secrets          secrets in the texts are replaced
packing          the texts' tokens, in sequences of 2048

Where ids are null, documents are taken to differ from all others and stay;
rows that repeat an id stand or fall together in ``near_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.llm import common, contamination, neardup, packing, quality, queries, secrets, tokens

#: The whole result depends on trained models and alignment: no SQL twin.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.quality_model(docs, common.read(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, least=0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = neardup.near_duplicates(docs, shingle=5, percent=80)
    kept = groups.filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = "benchmark_matches"
    while out in docs.columns:  # a column of the documents may have any name
        out += "_"
    found = contamination.annotate(docs, common.read(spark, sf_dir, "benchmark"), out=out)
    return found.filter(F.size(out) == 0).drop(out)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    samples = secrets.samples_from(docs.select(common.text_or_empty().alias("text")))
    clean = secrets.redacted(docs, secrets.train(samples))
    if "n_chars" in clean.columns:
        n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
        clean = clean.withColumn("n_chars", n)
    return clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokens.default_path(), capacity=2048)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to
    the shared folder and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
