"""Suffix-array dedup: maximal repeats from the common-prefix intervals of an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.anchors import Windows, contents, occurrences, segments
from rollcall.llm.common import ROW, materialise, numbered, ranges, small
from rollcall.llm.repeats import marks, without_marks

BYTES = Windows(length=200, gram=64, words=False, by_document=False)


def common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] agrees, a[:high] does not
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def maximal_groups(lcp: list[int], lefts: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of every maximal repeat of at least length items around the start of one group of suffixes, with all its occurrences.

    The suffixes are sorted; lcp[i] is the common prefix of suffixes i and i + 1, and lefts[i] what stands before
    suffix i, read backwards. A scan with a stack closes the intervals of the common-prefix tree from the deepest up,
    all children of an interval at once. Its members, in the order of what stands before them, form intervals by common left
    extension; such an interval is a repeat that cannot be extended to the left, and not to the right either
    if its members come from more than one child. Every occurrence is listed.
    """
    n = len(lefts)
    order = sorted(range(n), key=lefts.__getitem__)
    place = [0] * n
    for i, x in enumerate(order):
        place[x] = i

    def close(children: list[list[int]], depth: int) -> Iterator[tuple[int, int, list[int]]]:
        child = {x: c for c, members in enumerate(children) for x in members}
        merged = sorted(child)
        # how often the child has changed up to each member: an interval without change lies in one child
        changes = [0, *accumulate(child[x] != child[y] for x, y in zip(merged, merged[1:]))]
        open_left: list[tuple[int, int]] = []  # (common left extension, first member) of left intervals that may go on
        for i in range(1, len(merged) + 1):
            shared = common(lefts[order[merged[i - 1]]], lefts[order[merged[i]]]) if i < len(merged) else -1
            first = i - 1
            while open_left and open_left[-1][0] > shared:
                left, first = open_left.pop()
                if left + depth >= length and changes[first] < changes[i - 1]:
                    yield left, depth, [order[x] for x in merged[first:i]]
            if i < len(merged) and (not open_left or open_left[-1][0] < shared):
                open_left.append((shared, first))
        sets.append(merged)

    sets, depths = [[place[0]]], []
    for i in range(1, n + 1):
        now = lcp[i - 1] if i < n else -1
        while depths and depths[-1] > now:
            depth, children = depths[-1], [sets.pop()]
            while depths and depths[-1] == depth:
                depths.pop()
                children.append(sets.pop())
            yield from close(children, depth)
        if i < n:
            depths.append(now)
            sets.append([place[i]])


def _first_difference(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Of each pair of rows, the length of the common prefix, at most `most`."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 1 << 15):
        unequal = a[i : i + (1 << 15)] != b[i : i + (1 << 15)]
        out[i : i + (1 << 15)] = np.where(unequal.any(1), unequal.argmax(1), unequal.shape[1])
    return np.minimum(out, most)


def _sides(left, windows, data, offsets, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many items stand from each anchor on, and what stands before and from there, as matrices padded with zeros; what stands before is read backwards."""
    right = windows + length - 1 - left
    n, begin = len(left), offsets[:-1]
    after, before = np.zeros((n, int(right.max())), np.uint8), np.zeros((n, max(1, int(left.max()))), np.uint8)
    for s in range(0, n, 1 << 10):
        p = slice(s, s + (1 << 10))
        l, r, b = left[p], right[p], begin[p]
        rows = np.arange(s, s + len(l))
        after[np.repeat(rows, r), ranges(np.zeros(len(l), np.int64), r)] = data[ranges(b + l, r)]
        reach = ranges(np.zeros(len(l), np.int64), l)
        before[np.repeat(rows, l), reach] = data[np.repeat(b + l - 1, l) - reach]
    return right, before, after


def _sorted_suffixes(of: np.ndarray, anchor: np.ndarray, after: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The contents `of` by anchor and suffix, the common prefix of each two neighbours (0 between anchors), and the bounds of the anchors' groups."""
    key = np.ascontiguousarray(after[of]).view(f"S{after.shape[1]}").ravel()
    of = of[np.lexsort((key, anchor[of]))]
    a, b = of[:-1], of[1:]
    together = anchor[a] == anchor[b]
    lcp = np.where(together, _first_difference(after[a], after[b], np.minimum(right[a], right[b])), 0)
    return of, lcp, np.r_[0, np.flatnonzero(~together) + 1, len(of)]


def repeats(anchor, id, left, windows, data, offsets, length: int = BYTES.length) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and from its anchor on the maximal repeats of each content cover; -1 before it where there are none.

    Every run of length bytes that two contents of an anchor share holds the anchor, so one suffix for each
    content, the one that starts at its anchor, is enough: the suffix array is sorted within each anchor, with the common prefix
    of neighbours, and its maximal repeat groups are listed. A repeat of a content holds its anchor, so that its repeats
    together are one run, as far as any of them goes. Of two contents, the only group is read off directly.
    """
    right, before, after = _sides(left, windows, data, offsets, length)
    of, lcp, cut = _sorted_suffixes(np.arange(len(anchor)), anchor, after, right)
    reach_before, reach_after = np.full(len(anchor), -1, np.int64), np.full(len(anchor), -1, np.int64)
    two = np.flatnonzero(np.diff(cut) == 2)
    x, y, depth = of[cut[two]], of[cut[two] + 1], lcp[cut[two]]
    shared = _first_difference(before[x], before[y], np.minimum(left[x], left[y]))
    ok = shared + depth >= length
    for member in (x[ok], y[ok]):
        reach_before[member], reach_after[member] = shared[ok], depth[ok]
    for g in np.flatnonzero(np.diff(cut) > 2):
        s, e = cut[g], cut[g + 1]
        for l, r, members in maximal_groups(lcp[s : e - 1].tolist(), [before[i, : left[i]].tobytes() for i in of[s:e]], length):
            member = of[s:e][members]
            reach_before[member], reach_after[member] = np.maximum(reach_before[member], l), np.maximum(reach_after[member], r)
    return reach_before, reach_after


def groups(anchor, content, many, left, windows, data, offsets, length: int = BYTES.length) -> list[tuple[int, int, str, int]]:
    """(number, length, content, items before the anchor) for every content in every maximal repeat within the reach of its anchor.

    many says which contents occur more than once. Those stand for two equal suffixes, which form the same intervals
    as any number of them.
    """
    right, before, after = _sides(left, windows, data, offsets, length)
    of, lcp, cut = _sorted_suffixes(np.repeat(np.arange(len(anchor)), 1 + many), anchor, after, right)
    out, number = [], 0
    for s, e in zip(cut, cut[1:]):
        if e - s > 1:
            for l, r, members in maximal_groups(lcp[s : e - 1].tolist(), [before[i, : left[i]].tobytes() for i in of[s:e]], length):
                out += [(number, l + r, content[x], int(l)) for x in {of[s + m] for m in members}]
                number += 1
    return out


def remove_bytes(text: bytes, spans: list[tuple[int, int]], whole: bool, length: int = BYTES.length) -> tuple[int, int, int, bytes]:
    if whole:
        spans = [(0, len(text))] if len(text) >= length else []
    if not spans:
        return len(text), 0, 0, text
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    rest = b"".join([*kept, text[at:]])
    return len(text), len(text) - len(rest), len(spans), rest


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: Windows = BYTES) -> DataFrame:
    """repeat, length, row (number), id and start (in bytes) of all occurrences of the repeats of at least spec.length bytes.

    A repeat is as long as it can be within the reach of an anchor (spec.length + gap bytes around it), so a longer
    one shows as several that overlap; together they cover what remove_repeated_bytes removes. Copies are listed one by one,
    so this is for looking at a corpus, not for cleaning it. Hot anchors are listed like any other: one task holds all different
    contents of an anchor; their occurrences, which carry no text, are joined to the groups after that.
    """
    rows = numbered(docs.select(F.col(id_col).alias("__rc_id"), F.col(text_col).alias("__rc_text")))
    found = materialise(segments(rows, materialise(occurrences(rows, spec)), spec))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        offsets = np.r_[0, np.cumsum(pdf.payload.map(len))].astype(np.int64)
        anchor, content, before, windows = (pdf[c].to_numpy(np.int64) for c in ("anchor", "content", "before", "windows"))
        listed = groups(anchor, content, (pdf.n > 1).to_numpy(np.int64), before, windows, np.frombuffer(b"".join(pdf.payload), np.uint8), offsets, length=spec.length)
        name = int(anchor[0])
        return pd.DataFrame([(f"{name:x}.{n}", length, name, c, l) for n, length, c, l in listed], columns=["repeat", "length", "anchor", "content", "inside"])

    listed = materialise(contents(found).groupBy("anchor").applyInPandas(run, "repeat string, length int, anchor long, content long, inside int"))
    listed = found.select("anchor", "content", ROW, "first", "before").join(small(listed), ["anchor", "content"])
    listed = listed.select("repeat", "length", F.col(ROW).alias("row"), (F.col("first") + F.col("before") - F.col("inside")).alias("start"))
    return listed.join(rows.select(F.col(ROW).alias("row"), F.col("__rc_id").alias(id_col)), "row")


def remove_repeated_bytes(docs: DataFrame, outputs: dict[str, str], id_col: str = "doc_id", text_col: str = "text", spec: Windows = BYTES) -> DataFrame:
    """docs with outputs (name: one of n_items, n_removed, n_spans, kept_text, kept_sha256) added.

    Texts are UTF-8 bytes. Every byte in a string of spec.length bytes that also starts anywhere else, in the same
    text or another, is removed, all judged on the input. Null and empty texts have no bytes; rows that repeat
    an id are documents like any other; an empty table gives no rows. docs is read once, into a
    numbered copy that every later pass reads.
    """
    docs = numbered(docs)
    marked = marks(docs, id_col, text_col, spec, lambda *a: repeats(*a, length=spec.length), lambda t: F.coalesce(t, F.lit("")))
    return without_marks(docs, marked, lambda t, s, w: remove_bytes(t, s, w, spec.length), outputs, text_col)
