"""From raw documents to token digests: five stages, each of which works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabguard.llm import langid, lines, mixing, pieces, simhash
from tabguard.llm.common import saved
from tabguard.llm.queries import MODEL_PATH
from tabguard.runtime import tune

#: Bytes of one Arrow batch, unless a single row has more. Executors keep what their largest batches have taken, in idle Python
#: workers and outside the JVM's heap, also in stages without Python; ten thousand texts a batch, Spark's bound, have no limit.
BATCH_BYTES = 2 << 20


def _tuned(spark: SparkSession) -> None:
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text can have a language: none is rejected but texts without letters.

    ``lang``, by which a later stage mixes, is the language found where the score is 0.9 or more, else the given label; labels
    that the model has not learned stay.
    """
    _tuned(spark)
    return langid.keep_identified(docs, langid.train_on_documents(docs), lang_col="lang")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, lines that three or more of them hold left in the one with the largest id only."""
    _tuned(spark)
    return lines.without_repeats(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    _tuned(spark)
    return simhash.keep_representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that token shares of sources, languages and topics meet their flattened targets."""
    _tuned(spark)
    return mixing.sample_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents encoded and decoded."""
    _tuned(spark)
    return pieces.token_digests(docs, MODEL_PATH)


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Fingerprints, trained weights and tokens are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, the result of each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
