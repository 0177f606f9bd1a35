"""Corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes the documents that the stage before it kept and returns the
columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.llm import decontamination, jaccard, lines, packing, toxicity
from goldweave.llm.common import fold_of, read, scratch, settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; the model is the one of the toxicity query.

    Null and empty texts get the score of no terms, repeated rows equal ones; without labels every document stays.
    """
    settle(spark)
    cfg = toxicity.Settings()
    labels = read(spark, sf_dir, "labels").filter(fold_of(F.col("doc_id"), 5) != 0)
    machine = toxicity.fit(toxicity.training_rows(docs, labels, cfg), cfg)
    return toxicity.scored(docs, machine, score_column="__toxicity").filter("__toxicity < 0.5").select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their host; copies are left whole to the stage after this one.

    A null text stays null; n_chars, where there is such a column, follows the text that was cut.
    """
    cut = lines.drop_boilerplate(docs, scratch(spark, "pipeline-lines"))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the smallest id; of repeated rows one. Texts without words all stay."""
    work, inner = scratch(spark, "pipeline-near"), scratch(spark, "pipeline-near-join")
    joined = work.save(jaccard.jaccard_join(docs, inner).select("doc_id", "words_key", "kept"), "joined")
    inner.close()
    return jaccard.drop_linked(docs, joined).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark; null and empty texts share none. Without a benchmark all stay."""
    work, inner = scratch(spark, "pipeline-leaks"), scratch(spark, "pipeline-leaks-search")
    hit = decontamination.contamination(docs, read(spark, sf_dir, "benchmark"), inner).filter("n_hit > 0")
    found = work.save(hit.select("doc_id", "text_key", "n_hit"), "contamination")
    inner.close()
    return decontamination.drop_contaminated(docs, found).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens. Workers of earlier stages still hold memory, so fewer words are remembered than by the query."""
    settle(spark)
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")), remembered=250_000)


STAGES = [
    ("toxicity", drop_toxic), ("line_dedup", cut_lines), ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks), ("packing", pack),
]

# Learned scores and token ids cannot be written in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents``, each written and read again. Empty documents give no pieces; extra columns go through to the last stage."""
    work = scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return docs
