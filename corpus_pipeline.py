"""Corpus pipeline over ``documents``: from raw texts to packed training sequences.

1. ``toxicity``: documents that the classifier rejects go.
2. ``simhash``: of every class of near copies the document with the smallest id stays.
3. ``substrings``: passages of 50 words that a smaller document has too are cut out of the texts.
4. ``mixing``: every document as often as the mix of the sources takes it.
5. ``packing``: token sequences of 2048, one row per piece of a document.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame (all but the last with the columns of documents), which ``run``
writes as Parquet to the shared folder and reads again for the next stage.
The stages handle nulls, empty texts, repeated rows and empty tables as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import toxicity as tox
from riskmart.llm.common import ready, stored, table
from riskmart.llm.mixing import mixed
from riskmart.llm.packing import packed
from riskmart.llm.simhash import one_of_each
from riskmart.llm.substrings import without_repeats

#: Tokenizing and a trained classifier are not expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from the labels of the documents at hand, without the held-out fifth."""
    labels = table(spark, sf_dir, "labels")
    model = tox.fit(docs.where(~tox.held_out(5, 0)), labels.where(~tox.held_out(5, 0)))
    return tox.accepted(docs, model)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("substrings", substrings),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
