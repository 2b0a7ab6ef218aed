"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept. A stage takes
``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.

Null and empty texts fail the first stage. Rows that repeat a doc_id are judged
row by row in stages 1, 2 and 4, and one of them is left after stage 3; rows
without a doc_id take no part in stages 2 and 3. Extra columns are left behind. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid.llm.best_fit_packing import pack_documents
from quartergrid.llm.common import missing, of_checked_size, small_batches, staged, table
from quartergrid.llm.decontamination import contamination
from quartergrid.llm.jaccard_join import jaccard_classes
from quartergrid.llm.line_dedup import dedup_lines
from quartergrid.llm.quality_rules import quality_verdicts

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _tagged(docs: DataFrame) -> DataFrame:
    """Add ``tag_``, a hash of all that a verdict on a row depends on, and its id."""
    return docs.withColumn("tag_", F.xxhash64("text", F.coalesce("lang", F.lit("")), "doc_id"))


def _without(docs: DataFrame, verdicts: DataFrame, condition: str) -> DataFrame:
    """Rows of tagged ``docs`` but those that ``verdicts`` rejects.

    The operators saw the tag in place of the doc_id.
    """
    bad = staged(verdicts.filter(condition).select(F.col("doc_id").alias("tag_")).distinct(), "rejected")
    return docs.join(of_checked_size(bad), "tag_", "left_anti").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the bands of their language."""
    tagged = _tagged(docs)
    seen = tagged.select(F.col("tag_").alias("doc_id"), "text", "lang")
    return _without(tagged, quality_verdicts(seen), "not kept")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has, however short.

    A document that loses all its words this way goes.
    """
    left = dedup_lines(docs.select(*COLUMNS), min_words=1)
    emptied = (F.col("n_removed") > 0) & ~F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    return left.filter(~F.coalesce(emptied, F.lit(False))).select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.length("kept_text").cast("long").alias("n_chars"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least doc_id, of each group of near copies.

    Of rows that repeat a doc_id one stays.
    """
    others = jaccard_classes(docs, size=5, percent=80).filter("component_id < doc_id")
    bad = staged(others.select("doc_id").distinct(), "near_copies")
    left = missing(docs, bad, "doc_id").select(*COLUMNS)
    many = left.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id")
    many = staged(many, "repeated_ids")
    if many.isEmpty():
        return left
    again = of_checked_size(many)
    once = left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, "doc_id", "left_anti").unionByName(once)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    tagged = _tagged(docs)
    seen = tagged.select(F.col("tag_").alias("doc_id"), "text")
    return _without(tagged, contamination(seen, table(spark, sf_dir, "benchmark")), "contaminated")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return pack_documents(docs, with_ids=False, added=True)


def _in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with whole texts sent to Python few at a time: executors keep what earlier stages grew to."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _in_small_batches(quality_rules)),
    ("line_dedup", _in_small_batches(line_dedup)),
    ("jaccard_join", _in_small_batches(jaccard_join)),
    ("decontamination", _in_small_batches(decontamination)),
    ("best_fit_packing", _in_small_batches(best_fit_packing)),
]

#: Tokenisers and packing are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
