"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, common, contamination, html, idstore, neardup, packing, preference, quality, repeats, secrets, tokens,
    toxicity, vptree, whitening)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.read(spark, sf_dir, "documents"), tokens.default_path())


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preference.pairs(preference.swapped_answers(common.read(spark, sf_dir, "conversations")))
    return rows.withColumns({c: preference.joined(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op3_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.read(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(common.read(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(common.read(spark, sf_dir, "documents"), shingle=4, percent=80)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learnt only from labels of documents that aren't held out."""
    learn = labels.filter(~quality.held_out()).select("doc_id", F.col("quality").alias("label"))
    return quality.train(docs, learn)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return quality.score(docs, quality_model(docs, common.read(spark, sf_dir, "labels")))


def op8_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idstore.encode_documents(common.read(spark, sf_dir, "documents"), tokens.default_path())


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(common.read(spark, sf_dir, "documents"), length=100)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    samples = secrets.samples_from(docs.select(common.text_or_empty().alias("text")))
    return secrets.digest(secrets.scan(docs, secrets.train(samples)))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(common.read(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    labels = common.read(spark, sf_dir, "labels").filter(~quality.held_out())
    return toxicity.score(docs, toxicity.train(docs, labels.select("doc_id", F.col("toxic").alias("label"))))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(common.read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_preference_pairs, op3_vantage_point, op4_html_text, op5_decontamination,
    op6_near_duplicates, op7_quality, op8_id_store, op9_repeated_bytes, op10_secret_scan,
    op11_token_alignment, op12_toxicity, op13_embedding_whitening)}

#: DuckDB twins of the queries that SQL can express.
ORACLE: dict[str, str] = {"op2_preference_pairs": preference.ORACLE_SQL}
