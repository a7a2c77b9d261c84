"""A training corpus from ``documents``: classify, deduplicate, mask, mix, pack.

Every stage is a function of (spark, docs, sf_dir) whose result is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of ``docs``; rows with null or empty texts go where
the operator of the stage sends them (see its module). After ``mix`` a document may be there more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import minhash, mixing, packing, pii, quality_gbt
from meterline.llm.common import table
from meterline.session import cut

#: Shingles of five words and a similarity of 0.8, as for near-duplicate stages without a contract.
WIDTH, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts (operator 10)."""
    return quality_gbt.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id (operator 7)."""
    return minhash.distinct_documents(docs, WIDTH, PERCENT)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by the name of its kind (operator 3)."""
    return pii.masked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources has them (operator 8)."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents with their places in sequences (operator 9)."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", deduplicate),
    ("personal_data", mask),
    ("mixing", mix),
    ("packing", pack),
]

#: Trees, minimum hashes and token ids are not expressible; the tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
