"""From raw documents to packed training sequences, in stages that are written and read again.

1. quality rules          documents that fail the base rules or that boilerplate lines deplete go; boilerplate lines are cut
2. n-gram Jaccard join    of documents whose five-word shingles overlap by four fifths, one of each component stays
3. benchmark decontamination   documents that hold a passage of the benchmark go
4. secret scans           secrets in texts are replaced by a mark
5. best-fit packing       what is left, as pieces of sequences of 4096 tokens

Every stage works on all that its predecessor kept. All but the last return the columns of ``documents``, further ones untouched whatever
they are called.

Null, empty and blank texts fail the base rules and go. Of rows that are equal in id and text one stays, and of a group of copies the one with
the smallest id; documents without an id stay if no copy of theirs has one. A null source is a source of its own. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subtide.llm.decontamination import without_benchmark
from subtide.llm.jaccard_join import without_near_copies
from subtide.llm.line_quality import without_low_quality
from subtide.llm.packing import best_fit_packing
from subtide.llm.queries import tokenizer_file
from subtide.llm.secrets import without_secrets
from subtide.llm.shared import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_low_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL has no tokenizer; tests hold the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of the documents of ``sf_dir``; each stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
