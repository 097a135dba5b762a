"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All but the
last return the columns of ``documents``; further columns of the input are left out. The stages
handle nulls, empty and long texts, repeated rows and empty tables as their operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.llm import decontaminate, line_quality, mixing, simhash_index, token_files
from rigwatch.llm.queries import vocabulary
from rigwatch.llm.registry import table
from rigwatch.session import materialise, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; documents that fail the base rules or lose too much text go."""
    judged = line_quality.judge(docs.select(*COLUMNS)).where("kept")
    return judged.select("doc_id", F.col("cleaned").alias("text"), "lang", "source",
                         F.char_length("cleaned").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Gray-order index of SimHash fingerprints, then shingles; similarity 0.8 verified) stays: the smallest id."""
    return simhash_index.one_of_each(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, to meet the sources' targets."""
    drawn = docs.select(*COLUMNS, mixing.draw(["doc_id", F.crc32("text")]).alias("draw"))
    slim = materialise(drawn.select("source", "draw", line_quality.word_count(F.col("text")).alias("size")), "mix-input")
    plan = mixing.mix_plan(slim, mixing.cyclic_weights(slim))
    taken = mixing.repetitions(drawn, plan).where("repeats > 0")
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "repeats")).alias("_repeat")).drop("_repeat")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the mix in plane-shuffled blocks; a row per document, read back from them."""
    path = scratch_path(spark, "pipeline-ids")
    token_files.write_ids(docs, path, vocabulary())
    return token_files.documents_of(token_files.read_blocks(spark, path))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("tokens", tokens),
]
#: SimHash components, seeded draws and token ids cannot be stated in SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
