"""From raw documents to token ids: five stages, each written and read again.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last return the
columns of ``documents``; what a stage drops or changes is gone for the next one.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitloom.llm import bpe, decontamination, line_dedup, minhash, quality_rules
from gitloom.llm.common import table

MIN_LINE_DOCS, MIN_LINE_CHARS = 10, 1
NEAR_PERCENT = 80
RANK_FILE = "byte_bpe_50k.tiktoken"


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and all other columns as one, so that no operator's column replaces them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("__"), *others).alias("__others"))


def _unpacked(df: DataFrame, docs: DataFrame, text_changed: bool = False) -> DataFrame:
    """The columns of ``docs`` again, ``n_chars`` as the text now is."""
    out = []
    for c in docs.columns:
        if c in ("doc_id", "text"):
            out.append(F.col(c))
        elif c == "n_chars" and text_changed:
            out.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col("__others")[c].alias(c))
    return df.select(*out)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or a rule rejects go."""
    return _unpacked(quality_rules.judge(_packed(docs)).where("kept"), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten groups of near copies or more share go; a document that has nothing
    else goes.

    A text without near copies is a group of its own. Copies and near copies count once, so
    that no group loses its text here before the next stage keeps one of it.
    """
    kept = line_dedup.drop_frequent_lines(
        _packed(docs),
        MIN_LINE_DOCS,
        MIN_LINE_CHARS,
        groups=lambda source, texts: minhash.text_groups(source, texts, NEAR_PERCENT),
    )
    emptied = (F.col("n_dropped") > 0) & (F.ltrim("text", F.lit(quality_rules.SPACES)) == "")
    return _unpacked(kept.where(~emptied), docs, text_changed=True)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, one row of it if rows repeat."""
    return minhash.keep_one(docs, NEAR_PERCENT, repeats=False)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = table(spark, sf_dir, "benchmark")
    marked = decontamination.mark_contamination(_packed(docs), benchmark)
    return _unpacked(marked.where(~F.col("contaminated")), docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding gives the text back."""
    rank_file, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    narrow = docs.select("doc_id", "text", "lang", "source")
    decoded = bpe.decode(bpe.encode(narrow, rank_file, pattern), rank_file, pattern)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        same.alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: The last stage has no SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result but the last is a table in shared scratch,
    and what a stage stores on its way is removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = minhash.stored(spark, name, partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
