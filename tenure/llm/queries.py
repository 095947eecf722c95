"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bit_whitening, cross_polytope, filter_audit, language, line_dedup, lsh_forest, mixing, packing, pii, repetition, secrets, toxicity, vector_forest
from .common import table

#: The folder of tokenizer files is a setting of the session; unset, the installed public files are used.
TOKENIZERS = "tenure.llm.tokenizers"
TOKENIZER_FILE = "word_bpe_49k.json"
#: The file with the pseudonyms' secret key is a setting of the session; without it a test key is used, with a warning.
PII_KEY_FILE = "tenure.llm.piiKeyFile"
PII_TEST_KEY = "test key, not secret"


def tokenizer_path(spark: SparkSession) -> str:
    folder = spark.conf.get(TOKENIZERS, None)
    if folder:
        return f"{folder.rstrip('/')}/{TOKENIZER_FILE}"
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER_FILE))


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key_file = table(spark, sf_dir, "documents"), spark.conf.get(PII_KEY_FILE, None)
    if key_file:
        return pii.pseudonymised(docs, key_file=key_file)
    warnings.warn(f"{PII_KEY_FILE} is not set: pseudonyms are made with the public test key and can be undone", stacklevel=2)
    return pii.pseudonymised(docs, PII_TEST_KEY)


def op2_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_coverage(table(spark, sf_dir, "documents"))


def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model)


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(spark))


def op7_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op8_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.without_repeats(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "text", "n_lines", "n_removed")


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_documents(table(spark, sf_dir, "documents"))


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return cross_polytope.nearest(vectors, F.col("vec_id") % 20 == 0)


def op12_filter_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_bit_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_whitening.whitened(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    every = (
        op1_feistel_pseudonyms, op2_repetition_coverage, op3_projection_forest, op4_secret_ownership, op5_toxic_spans,
        op6_best_two_fit, op7_cube_mix, op8_winnowed_lines, op9_language_mixture, op10_lsh_forest, op11_cross_polytope, op12_filter_shapley,
        op13_bit_whitening, pipeline,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_projection_forest": vector_forest.ORACLE,
        "op10_lsh_forest": lsh_forest.ORACLE,
        "op12_filter_shapley": filter_audit.ORACLE,
    }
