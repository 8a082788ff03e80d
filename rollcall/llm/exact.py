"""Exact deduplication by progressive refinement: length, prefix hash, full hash. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import BROADCAST_ROWS, HEAVY_ROWS, HEAVY_SHARE, ROW, drop_rows, materialise, numbered, small, with_row

PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of docs: its number, id, keep_id, group_size, kept, and the columns in carry.

    Rows group by the length of the normalised text, then by a hash of its first characters, and only for
    rows of groups that are left is the full content hashed (SHA-256, which stands for the content). Each
    refinement joins keys and counts, never texts; the surviving keys are broadcast if they were counted at
    BROADCAST_ROWS or fewer, and beyond that every row is hashed in the scan. Counts combine before the
    shuffle, so a group with a third of all rows is one row from each task; the few heavy groups are joined back by broadcast.

    Null texts are empty texts. Of equal texts the smallest id stays; a null id loses to any other. Among
    rows with that id the first stays (kept), the others count as copies. An empty table gives no rows.
    docs must be a table of files or another frame that repeats its rows in the same order.
    """
    norm, length, prefix, full = "__rc_norm", "__rc_len", "__rc_prefix", "__rc_full"
    rows = with_row(docs, F.col(id_col).alias("__rc_id"), F.col(text_col).alias("__rc_text"), *[c.alias(f"__rc_c_{n}") for n, c in (carry or {}).items()])
    rows = rows.withColumn(norm, normalised(F.col("__rc_text"))).withColumn(length, F.octet_length(norm))
    head = F.xxhash64(F.substring(norm, 1, PREFIX_CHARS))

    lengths = materialise(rows.groupBy(length).agg(F.count("*").alias("n")).where("n > 1").select(length))
    heads = rows.join(small(lengths), length, "left_semi").groupBy(length, head.alias(prefix)).agg(F.count("*").alias("n"))
    heads = materialise(heads.where("n > 1").select(length, prefix, F.lit(True).alias("__rc_open")))

    if heads.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        open_rows = rows.withColumn(prefix, head).join(F.broadcast(heads), [length, prefix], "left")
    else:
        open_rows = rows.withColumn("__rc_open", F.lit(True))
    # a row that is alone gets a key of its own, so that no partition gathers them
    keyed = materialise(open_rows.select(
        ROW, "__rc_id", length, F.when(F.col("__rc_open"), F.sha2(norm, 256)).otherwise(F.concat(F.lit("#"), F.col(ROW))).alias(full),
        *[f"__rc_c_{n}" for n in carry or {}],
    ))
    first = F.min(F.struct(F.col("__rc_id").isNull().alias("none"), F.col("__rc_id").alias("id"), F.col(ROW).alias("row")))
    groups = keyed.groupBy(length, full).agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = materialise(groups)
    limit = max(HEAVY_ROWS, keyed.count() // HEAVY_SHARE)
    heavy = groups.where(F.col("n") > limit).select(length, full, F.col("first").alias("heavy_first"), F.col("n").alias("heavy_n"))
    # rows of heavy groups get keys of their own for the second join, so no key brings many rows to one task
    spread = keyed.join(F.broadcast(heavy), [length, full], "left").withColumn(full, F.when(F.col("heavy_n").isNull(), F.col(full)).otherwise(F.concat(F.lit("#"), F.col(ROW))))
    joined = spread.join(groups.where(F.col("n") <= limit), [length, full], "left").withColumns({"first": F.coalesce("first", "heavy_first"), "n": F.coalesce("n", "heavy_n")})
    return joined.select(
        ROW, F.col("__rc_id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("__rc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col(ROW), F.lit(True)).alias("kept"),
        *[F.col(f"__rc_c_{n}").alias(n) for n in carry or {}],
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts; columns as they were."""
    docs = numbered(docs)
    return drop_rows(docs, exact_groups(docs, id_col, text_col).where(~F.col("kept")))
