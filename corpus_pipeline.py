"""A training corpus from ``documents``, stage by stage, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.llm import mixing, near_dup, pieces, pii, rules, workers
from cadentia.session import drop_scratch, materialise, owned_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_OWNER = "corpus pipeline"


def _tidy(stage: Stage) -> Stage:
    """A stage's input has been written, so what the stages before it kept aside goes first."""

    @wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, _OWNER)
        workers.small_batches(spark)
        with owned_scratch(_OWNER):
            return stage(spark, docs, sf_dir)

    return tidied


@_tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test and the learned decision list keep."""
    return rules.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 0.8 and more of their five-word shingles shared."""
    return near_dup.deduplicated(docs, least=80)


@_tidy
def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced in the text."""
    return pii.pseudonymised(docs)


@_tidy
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


@_tidy
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document: what a training run reads."""
    ids = docs.select("doc_id", "lang", "source", pieces.encode("text").alias("ids"))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pseudonyms", pseudonyms),
    ("mix", mix),
    ("encode", encode),
]

#: The rules are learned and the pieces come from a Viterbi search: SQL can't state the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens`` of the finished corpus, a row per copy that is taken."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        with owned_scratch(f"{_OWNER}: {name}"):
            docs = materialise(found, name)
        for earlier, _ in STAGES:
            if earlier != name:
                drop_scratch(spark, f"{_OWNER}: {earlier}")
    return STAGES[-1][1](spark, docs, sf_dir)
