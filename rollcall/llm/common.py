"""What the corpus operators share: tables, shared storage, size-checked joins and text batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.storage import BROADCAST_ROWS, materialise, small, table

__all__ = ["BROADCAST_ROWS", "HEAVY_ROWS", "HEAVY_SHARE", "ROW", "drop_rows", "flat_bytes", "join_spread", "materialise", "numbered", "ranges", "small", "table", "text_batches", "with_row"]

ROW = "__rc_row"
#: A group of more rows than this, and than one in HEAVY_SHARE of all, is joined by broadcast: there are fewer than HEAVY_SHARE of them.
HEAVY_ROWS, HEAVY_SHARE = 1_000, 1_000


def with_row(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns of df (all, if none are given) with a number for each row: the stored one of a numbered copy, else one that holds for a single pass.

    A number that is made in the pass depends on how the files are split, which may change with the executors at hand:
    what is joined to a later pass by it must come from a numbered copy.
    """
    stored = [ROW] if ROW in df.columns else []
    df = df.select(*columns, *stored) if columns else df
    return df if stored else df.withColumn(ROW, F.monotonically_increasing_id())


def numbered(df: DataFrame) -> DataFrame:
    """df, with a number for each row, written once: every pass over it reads the same numbers. A numbered copy is returned as it is."""
    return df if ROW in df.columns else materialise(with_row(df))


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs, a numbered copy, without the rows whose number is in dropped (one column, ROW), and without the number."""
    return docs.join(small(materialise(dropped.select(ROW))), ROW, "left_anti").drop(ROW)


def join_spread(rows: DataFrame, side: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """rows, total of them, joined with side, which has one row for each of their keys and in column n (left out) how many rows have it.

    Keys of heavy groups are joined by broadcast, so that no key brings many rows to one task. Both are read twice: they should be materialised.
    """
    limit = max(HEAVY_ROWS, total // HEAVY_SHARE)
    heavy = F.broadcast(side.where(F.col(n) > limit).drop(n))
    light = rows.join(heavy.select(key), key, "left_anti").join(side.where(F.col(n) <= limit).drop(n), key)
    return light.unionByName(rows.join(heavy, key))


def text_batches(batches: Iterable[pa.RecordBatch], text: int, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: texts of at most limit bytes together, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and the n + 1 offsets of its rows; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - firsts, lengths)
