"""Which labelled documents a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text (null: empty text) leaves that remainder."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """o (a hash of the id), y and __rc_text of at most rows labelled ids: those of the smallest hash.

    The highest of several labels of an id counts; null labels and labels without document count for nothing.
    Only ids and labels are sorted, and the chosen ones, rows at most, are broadcast to the scan of the texts.
    """
    order = F.xxhash64("__rc_id")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__rc_id")).agg(F.max(label_col).cast("int").alias("y"))
    chosen = known.orderBy(order, "__rc_id").limit(rows)
    found = docs.select(F.col(id_col).alias("__rc_id"), F.col(text_col).alias("__rc_text")).join(F.broadcast(chosen), "__rc_id")
    return found.select(order.alias("o"), "y", "__rc_text")
