"""Documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the rows that the next one
works on; all but the last return the columns of ``documents``. A run writes
each stage as Parquet in the shared checkpoint folder and reads it back.

Every stage takes an empty table (and returns one), further columns of any name
(the last ignores them, the others return them), rows with null, equal or no ids,
and texts of any length, which are looked at whole. What it does with null and
empty texts and with repeated rows is said at each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm import langid, linededup, mixing, packing, simhash
from threadmill.llm.entries import remainder, table, tokenizer_path
from threadmill.llm.scratch import boxed, new_path, unboxed
from threadmill.plans.cluster import ship


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the codes recognise; those without a letter, or between two languages, go.

    Null, empty and blank texts have no letter. Repeated rows all stay or all go.
    """
    model = langid.fit(docs.filter(remainder(3) != 1))
    guess = langid.language(model, docs)
    judged = boxed(docs, guess=guess(F.col("text")))
    return unboxed(judged.filter((F.col("guess.lang_pred") != "und") & ~F.col("guess.ambiguous")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more different texts share; copies count once, so the next stage finds them whole.

    A text may end up empty; a null one stays null. Repeated rows lose the same lines.
    """
    return linededup.dedup_lines(docs, min_docs=10, keep_first=False, min_chars=1, per_text=True)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id, then the smallest text hash.

    Two documents are linked if the fingerprints of their five-word shingles differ
    in at most 4 of 64 bits, or their sets of these shingles are alike by 0.8 or
    more. Null, empty and blank texts form one group; of repeated rows one stays.
    """
    return simhash.keep_one(docs, distance=4, words_each=5, least=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their targets.

    A text without words, or null, is never taken. Null sources are one source. Repeated rows are drawn one by one.
    """
    return mixing.mix(docs, weights=(1.0, 2.0, 3.0), most=3.0, share=1.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids (little-endian uint32), sequence and offset.

    A null or empty text is the end id alone; repeated rows are packed one by one.
    Workers that earlier stages used keep fewer words' ids than packing alone would.
    """
    return packing.pack_documents(docs, tokenizer_path(), 4096, end_id=1, with_ids=True, store_words=60_000)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    def with_code(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    return with_code


STAGES: list[tuple[str, Stage]] = [
    ("language", _shipped(language_stage)),
    ("lines", _shipped(line_stage)),
    ("near_copies", _shipped(near_copy_stage)),
    ("mixing", _shipped(mixing_stage)),
    ("packing", _shipped(packing_stage)),
]

#: A trained classifier, a tokenizer and best-fit packing are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
