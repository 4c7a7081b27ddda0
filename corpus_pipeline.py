"""A corpus pipeline: language ID, near-duplicates, personal data, mixing, packing.

``STAGES`` are ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and works
on all rows its predecessor kept.  All but the last return the columns of
``documents``.  ``run`` writes each result to the shared scratch folder and reads
it again, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carryover.llm.common import on_workers, stored, table
from carryover.llm.dedup import keep_one_each
from carryover.llm.language import keep_identified
from carryover.llm.mixing import mix_sources
from carryover.llm.packing import pack_documents
from carryover.llm.queries import public_tokenizer
from carryover.llm.surrogates import count_name, replace_personal_data


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return keep_one_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data; ``n_chars`` follows the text."""
    new, n_replaced = replace_personal_data(docs), count_name(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        new = new.withColumn("n_chars", F.when(F.col(n_replaced) > 0, length).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources evened out as far as no document is seen more than twice, none less than once."""
    return mix_sources(docs, max_repeat=2.0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece."""
    return pack_documents(docs, public_tokenizer())


def _stage(work):
    """A stage that may be the first of a session: its workers can import the package."""

    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return work(spark, docs, sf_dir)

    return stage


STAGES = [
    ("language_id", _stage(language_id)),
    ("near_dedup", _stage(near_dedup)),
    ("pii", _stage(personal_data)),
    ("mixing", _stage(mixing)),
    ("packing", _stage(packing)),
]

#: Tokenising, sketches and keyed draws have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
