"""The corpus pipeline: its stages, each from a table of documents to the next one's input."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from commitlens.llm import bpe, fertility, mixing, pii, simhash  # noqa: E402
from commitlens.llm.common import table  # noqa: E402
from commitlens.llm.queries import vocabulary  # noqa: E402
from commitlens.session import written  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word, line and vocabulary rules."""
    return fertility.keep_good(docs, vocabulary("piece_bpe_32k.model"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, at most 3 bits apart."""
    return simhash.keep_one_each(docs, shingle=3, radius=3)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    return pii.mask(docs, length_column="n_chars")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources flattened to nine tenths of even entropy: every document once, small sources again, at most twice."""
    return mixing.mixed_documents(docs, mixing.Mixture(entropy=0.92, repeats=2.0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of every document drawn."""
    return bpe.digests(bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"), decoded=True))


STAGES = [("quality", quality), ("dedup", dedup), ("privacy", privacy), ("mixing", mixture), ("encode", encode)]

#: Tokenisers, SimHash and learned labelers have no SQL form; the tests restate every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two, the rows lie in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
