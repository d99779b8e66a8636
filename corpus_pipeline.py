"""From raw documents to packed sequences: language ID, exact, near and substring dedup, best-fit packing.

Every stage takes texts of any length, keeps all columns whatever their names (the last returns pieces), and gives no rows for
an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import exact_dedup, jaccard_join, language, packing, substrings
from newsloom.llm._common import Staged, documents

#: A text stays if it has letters and one language holds this share of its words or more.
LANGUAGE_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those of which no language holds LANGUAGE_SHARE; learns from docs' own labels.

    Null and empty texts go; repeated rows are judged alike; where fewer than two languages are labelled, all lettered texts stay.
    """
    return language.accept(docs, language.learn(docs), LANGUAGE_SHARE)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space; null counts as empty.

    The longest text stays, then the smallest id, a null id last; of rows alike in both, one.
    """
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class that links of five-word shingle sets, 0.8 alike or more, hold together: its least id.

    Null and wordless texts stay, each in a class of its own; rows that share an id, or have none, count by their order.
    """
    return jaccard_join.keep_one(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that start earlier too; texts that lose all their words go.

    Null ids come first, and rows that share an id follow each other by text; null and short texts lose nothing.
    """
    return substrings.cut_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, in sequences of 1024 tokens at most; null counts as empty, and each row is packed."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("part")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("substring_dedup", repeated_spans),
    ("best_fit_packing", sequences),
]

#: SQL can express neither the language model nor the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
