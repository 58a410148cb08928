"""The corpus pipeline: quality, near duplicates, secrets, mixing, packing.

Each stage reads the documents its predecessor kept and returns the columns of
documents; the last returns packed pieces. ``run`` writes each stage's result
into the cluster's shared folder and reads it again, so an executor that is lost
costs its running tasks only; a stage's table goes when the next one is written.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from heddle.llm import mixing, packing, quality, secrets, simhash_sets
from heddle.llm.batches import text_batches
from heddle.plans.durable import Scratch
from heddle.sources import table

#: Shares of tokens by language that mixing brings about by repeating documents: with
#: the least budget under which no language shrinks, so that each document stays.
TARGETS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, does not reject.

    A document without any text to judge is kept if the labels' mean is.
    """
    text_batches(spark)
    model = quality.fit(*quality.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return quality.keep_scored(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each component of texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    text_batches(spark)
    return simhash_sets.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark."""
    text_batches(spark)
    return secrets.redact(docs, secrets.train_on(docs))


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at the rates that bring the languages' tokens to TARGETS."""
    labelled = mixing.labelled_languages(docs, table(spark, sf_dir, "labels"))
    return mixing.apply_rates(docs, mixing.mixing_rates(docs, labelled, TARGETS, budget=None))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    text_batches(spark)
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY)).drop("ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_languages),
    ("packing", pack_windows),
]

#: The stages have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result a durable table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        if number:
            scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
