"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet in the
shared scratch folder and read again as the next stage's documents. All stages but the last
return the columns of ``documents``.

``ORACLE_SQL`` is None: SQL can express neither the learned stages nor the token ids; the
tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.llm import bag_minhash, bpe, decontaminate, language_id, toxicity
from tamarind.llm.common import Workspace, crc_mod

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: A document whose best language is less probable than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5

ORACLE_SQL = None


def _kept(docs: DataFrame, apply, added: tuple[str, ...], keep) -> DataFrame:
    """The rows of ``docs`` for which an operator's result satisfies ``keep``, with their own
    columns only: one that has the name of an added column is renamed meanwhile."""
    taken = {c.lower() for c in added}
    names = {c: f"_own{i}" if c.lower() in taken else c for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()])
    return apply(renamed).where(keep).select(*[F.col(f"`{name}`").alias(c) for c, name in names.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters or without a probable language."""
    model = language_id.learn(docs, PIECES_FILE, crc_mod(F.col("doc_id"), 4) != 2)
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return _kept(docs, lambda d: language_id.identify(d, model), ("lang_pred", "score"), sure)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    machine = toxicity.learn(docs, labels, crc_mod(F.col("doc_id"), 4) != 2)
    return _kept(docs, lambda d: toxicity.score(d, machine), ("score", "predicted"), F.col("predicted") == 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class, the one with the smallest id."""
    return bag_minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _kept(docs, lambda d: decontaminate.decontaminate(d, benchmark), ("n_words", "n_hit", "items", "hit_spans", "contaminated"), ~F.col("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``token_ids``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; documents whose
    text does not come back from its tokens are dropped (byte-level tokens always give it back)."""
    out = bpe.bpe_encode(docs, BPE_FILE, decode=True)
    out = out.where(F.col("decoded") == F.coalesce("text", F.lit("")))
    return (out.withColumn("n_tokens", F.size("token_ids").cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256))
            .withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded"))


STAGES = [
    ("language", identify_language),
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of ``sf_dir``."""
    ws = Workspace(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = ws.write(stage(spark, docs, sf_dir), name)
        if i:
            ws.drop(STAGES[i - 1][0])
    return docs
