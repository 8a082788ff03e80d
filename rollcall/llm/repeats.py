"""What the two repeat removers share: equal documents first, then spans, then the texts without them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.anchors import Solver, Windows, spans_of
from rollcall.llm.common import ROW, materialise, small, text_batches

#: Marked rows, and spans in them, that may be broadcast: some 40 MB.
BROADCAST_MARKS = 500_000
BROADCAST_SPANS = 1_000_000

#: What may be added to a document: counts of its items, and what is left of the text.
OUTPUTS = {"n_items": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_text": T.BinaryType(), "kept_sha256": T.StringType()}


def marks(docs: DataFrame, id_col: str, text_col: str, spec: Windows, solver: Solver, content: Callable[[Column], Column]) -> DataFrame:
    """ROW, whole and spans of the rows of docs, a numbered copy, that lose something; whole means every item, if there is a window.

    Rows of equal content (by a 128-bit hash) are settled first: by one row for each content. With by_document the
    others lose everything to the smallest id among them, else all rows of the content do.
    """
    rows = docs.select(F.col(id_col).alias("__rc_id"), F.col(text_col).alias("__rc_text"), ROW)
    keys = materialise(rows.select(ROW, F.coalesce(F.col("__rc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.md5(content(F.col("__rc_text"))).alias("k")))
    groups = keys.groupBy("k").agg(F.min(F.struct("id", ROW)).alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = materialise(keys.join(groups, "k").select(ROW, (F.col("id") > F.col("first.id")).alias("later"), (F.col(ROW) != F.col(f"first.{ROW}")).alias("other")))
    dropped, whole = ("later", "later") if spec.by_document else ("other", "true")
    left = rows.join(small(copies.where(dropped).select(ROW)), ROW, "left_anti")
    found = spans_of(left, spec, solver)
    whole = copies.where(whole).select(ROW, F.lit(True).alias("whole"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return materialise(found.join(whole.select(ROW), ROW, "left_anti").select(ROW, F.lit(False).alias("whole"), "spans").unionByName(whole))


def without_marks(docs: DataFrame, marked: DataFrame, remove: Callable, outputs: dict[str, str], text_col: str) -> DataFrame:
    """docs, a numbered copy, with outputs (name: one of OUTPUTS) added and without the number; columns of those names are replaced.

    remove(text, spans, whole) gives the number of items, of removed items, of spans, and the bytes kept. The marks are
    broadcast if they were counted at BROADCAST_MARKS rows and BROADCAST_SPANS spans or fewer, else joined by shuffle.
    """
    size = marked.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("spans")).first()
    marked = marked.select(ROW, F.col("whole").alias("__rc_whole"), F.col("spans.start").alias("__rc_start"), F.col("spans.end").alias("__rc_end"))
    marked = F.broadcast(marked) if size.rows <= BROADCAST_MARKS and size.spans <= BROADCAST_SPANS else marked
    kept = [f for f in docs.schema.fields if f.name not in (ROW, *outputs)]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias("__rc_text"), ROW)
    rows = rows.join(marked, ROW, "left").select(*[F.col(f"`{f.name}`") for f in kept], "__rc_text", "__rc_whole", "__rc_start", "__rc_end")
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, n):
            made: dict[str, list] = {name: [] for name in outputs}
            for text, whole, start, end in zip(*(batch.column(n + i).to_pylist() for i in range(4))):
                items, removed, spans, rest = remove((text or "").encode("utf-8", "surrogatepass"), list(zip(start or (), end or ())), bool(whole))
                values = {"n_items": items, "n_removed": removed, "n_spans": spans, "kept_text": rest}
                for name, kind in outputs.items():
                    made[name].append(hashlib.sha256(rest).hexdigest() if kind == "kept_sha256" else values[kind])
            kinds = {"kept_text": pa.binary(), "kept_sha256": pa.string()}
            arrays = [pa.array(made[name], kinds.get(kind, pa.int64())) for name, kind in outputs.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], names=[*[f.name for f in kept], *outputs])

    return rows.mapInArrow(run, T.StructType([*kept, *[T.StructField(name, OUTPUTS[kind]) for name, kind in outputs.items()]]))
