"""Bounded samples of labelled documents, and the split that keeps some rows out of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text is a multiple of five (a null id: empty text)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id, text, label`` (0 or 1) of about ``max_rows`` labelled rows that are not held out.

    Ids are drawn by hash, so each labelled id is as likely as any other and a second run
    draws the same. Of several labels of an id the largest counts, of several texts the
    smallest; rows with a null id or label are left out. The drawn ids are at most a little
    more than ``max_rows``, which bounds what is broadcast.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    total = known.count()
    slots = 1 << 30
    share = slots if total <= max_rows else slots * max_rows // total
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(slots)) < share)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(drawn), "doc_id")
    return joined.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
