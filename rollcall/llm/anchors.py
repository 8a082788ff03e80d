"""Routing of repeats: windows meet where they share an anchor, and only anchors that occur twice move any content.

A window is a run of `length` items (words or bytes) of one document. Its anchor is the gram of `gram` items
in it with the smallest hash (the leftmost one of several), so equal windows have equal anchors at equal
places. Consecutive windows with one anchor occurrence make a segment. The stages:

1. `occurrences`: each block of documents names its anchors once; a shuffle by anchor finds those named twice.
2. `segments`: those go back to their blocks, and only their segments are cut out of the texts. Equal segments of a
   batch carry their items once.
3. `contents`: equal segments become one content, with partial aggregates, so no copies meet in a task, however many there are.
4. a solver gets the different contents of an anchor together and returns for each what it repeats, as one run around
   the anchor (all repeats of a content hold its anchor, so together they are one run).
5. the occurrences of a content, which carry no items, are joined to what was found for it.

An anchor of more than `hot` different contents is too common to be an anchor: its windows are their own
anchors (a gram of `length` items), so they are counted with partial aggregates and joined back.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ROW, flat_bytes, materialise, ranges, small, text_batches
from rollcall.llm.hashing import mix, range_hashes, spans, window_hashes

_PLACE = np.uint64((1 << 24) - 1)
#: Items, and segments, that are worked on at once.
_PIECE, _SLICE = 1 << 18, 1 << 12
#: Bytes of text whose items are in memory at once (some hundred bytes for each).
_PART = 1 << 17
#: Documents of a block: this many neighbouring rows.
BLOCK_BITS = 6
NULL_ID = (1 << 63) - 1
#: Contents, of some 100 bytes each, that may be broadcast to their occurrences.
BROADCAST_CONTENTS = 200_000
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def release() -> None:
    """Gives freed memory back to the system: a reused worker would keep its peak otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@dataclass(frozen=True)
class Windows:
    """length and gram in items; hot: different contents that an anchor may have before its windows are their own anchors; by_document: whether repeats within a document count for nothing."""

    length: int
    gram: int
    words: bool
    by_document: bool
    hot: int = 4096


@dataclass
class Items:
    """The items of a batch of texts: their values (words: hashes) end to end, the n + 1 offsets of the rows, and the bytes with each item's start and end in them."""

    values: np.ndarray
    offsets: np.ndarray
    data: np.ndarray
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def stretches(self, first: np.ndarray, size: np.ndarray) -> pa.Array:
        """The bytes of size items from each first one on."""
        start, end = (first, first + size) if self.starts is None else (self.starts[first], self.ends[first + size - 1])
        cuts = np.r_[0, np.cumsum(end - start)].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(self.data[ranges(start, end - start)].tobytes())])


def items_of(data: np.ndarray, offsets: np.ndarray, words: bool) -> Items:
    if not words:
        return Items(data, offsets, data)
    starts, ends, rows = spans(data, offsets, ~_SPACE)
    return Items(range_hashes(data, starts, ends), np.searchsorted(rows, np.arange(len(offsets))), data, starts, ends)


def items(texts: pa.Array, words: bool) -> Items:
    return items_of(*flat_bytes(texts), words)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of width values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


@dataclass
class Segments:
    """Of each segment: row, place of the anchor, first and last window start (all in items of the batch), and the anchor (48 bits)."""

    row: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray


def cut(values: np.ndarray, offsets: np.ndarray, spec: Windows) -> Segments:
    """The segments of all rows, in order."""
    sizes = np.maximum(np.diff(offsets) - spec.length + 1, 0)
    found: list[tuple[np.ndarray, ...]] = []
    for base in range(0, len(values), _PIECE):
        part = values[base : base + _PIECE + spec.length - 1]
        if len(part) < spec.length:
            break
        low, high = np.clip(offsets[:-1], base, base + _PIECE), np.clip(offsets[:-1] + sizes, base, base + _PIECE)
        starts = ranges(low - base, high - low)
        if not len(starts):
            continue
        grams = window_hashes(part.astype(np.uint64) + np.uint64(1), spec.gram)
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding_min(keys, spec.length - spec.gram + 1)[starts] & _PLACE).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), high - low)
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
        last = np.r_[new[1:], len(place)] - 1
        found.append((row[new], place[new] + base, starts[new] + base, starts[last] + base, (grams[place[new]] >> np.uint64(16)).astype(np.int64)))
    if not found:
        return Segments(*[np.zeros(0, np.int64)] * 5)
    return Segments(*map(np.concatenate, zip(*found)))


def occurrences(rows: DataFrame, spec: Windows) -> DataFrame:
    """block and anchor of every anchor that more than one block names, or one block twice. rows: ROW, __rc_id, __rc_text."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 1, _PART):
            number = batch.column(0).to_numpy(zero_copy_only=False)
            made = items(batch.column(1), spec.words)
            found = cut(made.values, made.offsets, spec)
            block, row = number[found.row] >> BLOCK_BITS, found.row
            order = np.lexsort((row, block, found.anchor))
            block, row, anchor = block[order], row[order], found.anchor[order]
            if not len(anchor):
                continue
            new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])])
            end = np.r_[new[1:], len(anchor)]
            twice = (row[end - 1] != row[new]) if spec.by_document else end - new > 1
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new]), pa.array(2 * block[new] + twice)], names=["anchor", "b"])
        release()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by anchor. Of the last anchor, one row at most is held back: until a second one comes."""
        held_a, held_b, shown = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            anchor, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            anchor, b = np.r_[held_a, anchor], np.r_[held_b, b]
            if not len(anchor):
                continue
            new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            size = np.diff(np.r_[new, len(anchor)])
            flagged = (size > 1) | (np.add.reduceat(b & 1, new) > 0) | (anchor[new] == (shown if shown is not None else -1))
            wait = not flagged[-1]
            held_a, held_b = (anchor[-1:], b[-1:]) if wait else (anchor[:0], b[:0])
            shown = None if wait else anchor[-1]
            chosen = np.repeat(flagged, size)
            yield pa.RecordBatch.from_arrays([pa.array(b[chosen] >> 1), pa.array(anchor[chosen])], names=["block", "anchor"])
        release()

    named = rows.select(ROW, "__rc_text").mapInArrow(name, "anchor long, b long")
    return named.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(keep, "block long, anchor long")


#: A segment: its anchor, a hash of its items and the anchor's place in it, its row and id, the place of its first item, how many
#: items stand before its anchor, its number of windows, and the bytes of its items, which only the first of equal segments of a batch carries.
SEGMENT = "anchor long, content long, __rc_row long, id long, first int, before int, windows int, payload binary"
_NAMES = ["anchor", "content", ROW, "id", "first", "before", "windows", "payload"]


def segments(rows: DataFrame, flagged: DataFrame, spec: Windows) -> DataFrame:
    """The segments of flagged anchors. Texts and their block's flagged anchors come together in one sorted stream, anchors first."""
    texts = rows.select(F.shiftright(ROW, BLOCK_BITS).alias("block"), F.lit(1).alias("kind"), ROW, F.coalesce(F.col("__rc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "__rc_text", F.lit(None).cast("long").alias("anchor"))
    wanted = flagged.select("block", F.lit(0).alias("kind"), F.lit(None).cast("long").alias(ROW), F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("__rc_text"), "anchor")
    stream = texts.unionByName(wanted).repartition("block").sortWithinPartitions("block", "kind").select("block", "kind", ROW, "id", "__rc_text", "anchor")

    def made(batch: pa.RecordBatch, anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        whole = items(batch.column(4), spec.words)
        found = cut(whole.values, whole.offsets, spec)
        at = np.minimum(np.searchsorted(anchors, found.anchor), len(anchors) - 1)
        kept = anchors[at] == found.anchor
        row, place, first, last, anchor = (v[kept] for v in (found.row, found.place, found.first, found.last, found.anchor))
        number, ids = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)[row], batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)[row]
        before, windows = place - first, last - first + 1
        size = windows + spec.length - 1
        content = mix(range_hashes(whole.values, first, first + size) ^ mix((before << 32 | windows).astype(np.uint64)))
        chief = np.zeros(len(row), bool)
        chief[np.unique(content ^ mix(anchor.view(np.uint64)), return_index=True)[1]] = True
        for s in range(0, len(row), _SLICE):
            p = slice(s, s + _SLICE)
            mine = chief[p]
            payload = whole.stretches(first[p][mine], size[p][mine])
            payload = payload.take(pa.array(np.cumsum(mine) - 1, mask=~mine))
            columns = [anchor[p], content[p].view(np.int64), number[p], ids[p], (first - whole.offsets[row])[p], before[p], windows[p]]
            kinds = [np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int32]
            yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(k)) for c, k in zip(columns, kinds)], payload], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, carried_block = np.zeros(0, np.int64), None
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(block):
                continue
            is_text = batch.column(1).to_numpy(zero_copy_only=False) == 1
            anchors = batch.column(5).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            # a flagged anchor is flagged in every block, so those of all blocks in sight may be looked up together
            known = np.unique(np.r_[carried, anchors]) if carried_block == block[0] else np.unique(anchors)
            if len(known) and is_text.any():
                for part in text_batches([batch.filter(pa.array(is_text))], 4, _PART):
                    yield from made(part, known)
            of_last = (block == block[-1])[~is_text] if len(anchors) else np.zeros(0, bool)
            held = anchors[of_last]
            carried = np.r_[carried, held] if carried_block == block[-1] else held
            carried_block = block[-1]
        release()

    return stream.mapInArrow(run, SEGMENT)


def contents(found: DataFrame) -> DataFrame:
    """anchor, content, the least id that has it, how often it occurs, before, windows and payload, for each content of the segments.

    Two segments are one content if 48 bits of the anchor's hash and 64 of the content's agree.
    """
    return found.groupBy("anchor", "content").agg(
        F.min("id").alias("id"), F.count("*").alias("n"), F.max("before").alias("before"), F.max("windows").alias("windows"), F.first("payload", ignorenulls=True).alias("payload")
    )


#: solver(anchor, id, before, windows, data, offsets) gets the different contents of whole anchors, sorted by anchor and id, and tells how many items
#: before and from the anchor on each repeats; -1 before it where there are none.
Solver = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
_FOUND = "anchor long, content long, id long, n long, before int, windows int, reach_before int, reach_after int"


def solved(distinct: DataFrame, solver: Solver, most: int = 1 << 12) -> DataFrame:
    """What solver finds in whole groups of an anchor, about most contents at a time; contents that neither repeat anything nor occur twice are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            anchor, _, id, n, before, windows = (t.column(i).to_numpy() for i in range(6))
            data, offsets = flat_binary(t.column(6))
            reach = solver(anchor, id, before.astype(np.int64), windows.astype(np.int64), data, offsets)
            kept = (reach[0] >= 0) | (n > 1)
            columns = [t.column(i).to_numpy()[kept] for i in range(6)]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), *[pa.array(r[kept].astype(np.int32)) for r in reach]], names=[f.split()[0] for f in _FOUND.split(", ")])

        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < most:
                continue
            t = pa.Table.from_batches(held)
            anchor = t.column(0).to_numpy()
            at = int(np.searchsorted(anchor, anchor[-1]))
            if at:
                yield solve(t.slice(0, at))
                t = t.slice(at).combine_chunks()
            held, rows = t.to_batches(), t.num_rows if at else 0
        t = pa.Table.from_batches(held) if held else None
        if t is not None and t.num_rows:
            yield solve(t)
        del held, t
        release()

    ordered = distinct.select("anchor", "content", "id", "n", "before", "windows", "payload").repartition("anchor").sortWithinPartitions("anchor", "id")
    return ordered.mapInArrow(run, _FOUND)


def flat_binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    texts = pa.concat_arrays(column.chunks).cast(pa.large_binary()) if column.num_chunks else pa.array([], pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def hot_solved(distinct: DataFrame, spec: Windows) -> DataFrame:
    """The same for contents of hot anchors: each window is an anchor of its own, which is told by 112 bits of hash."""

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(s, _SLICE)
                windows = batch.column(5).to_numpy().astype(np.int64)
                whole_items = items_of(*flat_binary(pa.chunked_array([batch.column(6)])), spec.words)
                of = np.repeat(np.arange(len(windows)), windows)
                at = ranges(np.zeros(len(windows), np.int64), windows)
                key = window_hashes(whole_items.values.astype(np.uint64) + np.uint64(1), spec.length)[whole_items.offsets[of] + at]
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(pa.array(of)) for i in range(6)], pa.array(key.view(np.int64)), pa.array(at.astype(np.int32))], names=[*_NAMES[:2], "id", "n", "before", "windows", "key", "at"])
        release()

    all_windows = distinct.select("anchor", "content", "id", "n", "before", "windows", "payload").mapInArrow(windows_of, "anchor long, content long, id long, n long, before int, windows int, key long, at int")
    totals = all_windows.groupBy("anchor", "key").agg(F.min("id").alias("least"), F.sum("n").alias("total"))
    hit = F.col("least") < F.col("id") if spec.by_document else F.col("total") > 1
    reach = all_windows.join(totals, ["anchor", "key"]).groupBy("anchor", "content", "id", "n", "before", "windows").agg(
        F.coalesce(F.max(F.when(hit, F.col("before") - F.col("at"))), F.lit(-1)).cast("int").alias("reach_before"), F.coalesce(F.max(F.when(hit, F.col("at") + spec.length - F.col("before"))), F.lit(-1)).cast("int").alias("reach_after")
    )
    return reach.where("reach_before >= 0 OR n > 1")


def hot_anchors(distinct: DataFrame, spec: Windows) -> DataFrame:
    """The anchors of more than spec.hot contents, counted with partial aggregates."""
    return materialise(distinct.groupBy("anchor").count().where(F.col("count") > spec.hot).select("anchor"))


def spans_of(rows: DataFrame, spec: Windows, solver: Solver) -> DataFrame:
    """ROW and its sorted, disjoint spans (array of start, end), in items, for every row that has any."""
    cut_out = materialise(segments(rows, materialise(occurrences(rows, spec)), spec))
    distinct = materialise(contents(cut_out))
    hot = hot_anchors(distinct, spec)
    reach = solved(distinct.join(small(hot), "anchor", "left_anti"), solver)
    if hot.limit(1).count():
        reach = reach.unionByName(hot_solved(distinct.join(small(hot), "anchor", "left_semi"), spec))
    reach = reach.select("anchor", "content", F.col("id").alias("least"), "n", "before", "windows", "reach_before", "reach_after")
    # a content that occurs twice is a repeat from end to end; by document, for all but the least id that has it
    whole = F.col("id") > F.col("least") if spec.by_document else F.col("n") > 1
    place = F.col("first") + F.col("before")
    found = cut_out.select("anchor", "content", ROW, "id", "first").join(small(materialise(reach), BROADCAST_CONTENTS), ["anchor", "content"]).where(whole | (F.col("reach_before") >= 0))
    found = found.select(ROW, F.when(whole, F.col("first")).otherwise(place - F.col("reach_before")).alias("start"), F.when(whole, F.col("first") + F.col("windows") + spec.length - 1).otherwise(place + F.col("reach_after")).alias("end"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (ROW, start, end) sorted by ROW and start: overlapping and touching ones become one."""
        row, start, end = (np.zeros(0, np.int64) for _ in range(3))

        def joined(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            new_row = np.r_[True, row[1:] != row[:-1]]
            group = np.cumsum(new_row)
            reach = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
            new = new_row.copy()
            new[1:] |= start[1:] > reach[:-1]
            at = np.flatnonzero(new)
            return row[at], start[at], np.maximum.reduceat(end, at)

        for batch in batches:
            more = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            row, start, end = (np.r_[a, b] for a, b in zip((row, start, end), more))
            if not len(row):
                continue
            row, start, end = joined(row, start, end)
            if len(row) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(row[:-1]), pa.array(start[:-1]), pa.array(end[:-1])], names=[ROW, "start", "end"])
            row, start, end = row[-1:], start[-1:], end[-1:]
        if len(row):
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(start), pa.array(end)], names=[ROW, "start", "end"])

    merged = found.repartition(ROW).sortWithinPartitions(ROW, "start").mapInArrow(join, f"{ROW} long, start long, end long")
    return merged.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
