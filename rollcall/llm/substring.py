"""Substring dedup: relative Lempel-Ziv factors of documents against indexed blocks of earlier text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.anchors import Windows, items_of
from rollcall.llm.common import numbered, ranges
from rollcall.llm.hashing import mix, spread_hashes
from rollcall.llm.repeats import marks, without_marks

WORDS = Windows(length=13, gram=5, words=True, by_document=True)


def factors(anchor, id, before, windows, data, offsets, length: int = WORDS.length) -> tuple[np.ndarray, np.ndarray]:
    """How many words before and from its anchor on the factors of each content cover; -1 before it where there are none.

    The contents come sorted by anchor and id. Those of an anchor are its reference block; they are aligned at the
    anchor, as equal windows hold it at the same place. The block is indexed by its runs of length words or more from each start:
    for each run, the smallest id that has it there. A content is parsed greedily from the left: where the block has
    its next length words under a smaller id, the factor is the longest run that the block has under such an id; where
    it has not, one word is a literal. Where a factor ends, the windows that straddle the end are looked up as well, so that
    a run which the block has elsewhere starts a factor before the last one is over. The words of each factor are compared, by 64 bits of each.
    """
    parsed = items_of(data, offsets, True)
    words, begins, n = parsed.values, parsed.offsets[:-1], len(anchor)
    of = np.repeat(np.arange(n), windows)  # the content of each window
    nth = ranges(np.zeros(n, np.int64), windows)
    longer = windows[of] - nth  # runs that start with the window
    start, extra = np.repeat(np.arange(len(of)), longer), ranges(np.zeros(len(of), np.int64), longer)
    at = begins[of] + nth
    keys = mix(spread_hashes(words, at[start], length + extra) ^ mix(anchor.view(np.uint64))[of[start]] ^ mix((nth - before[of] + (1 << 20)).astype(np.uint64) << np.uint64(8))[start])
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]
    source = np.empty(len(keys), np.int64)
    source[order] = np.repeat(order[new], np.diff(np.r_[np.flatnonzero(new), len(keys)]))
    has = id[of[start[source]]] < id[of[start]]
    # what the block has of a run, it has of each shorter one with the same start
    longest = np.bincount(start[has], minlength=len(of))
    first_run = np.cumsum(longer) - longer
    reach_before, reach_after = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    none = len(of)
    following = np.r_[np.minimum.accumulate(np.where(longest > 0, np.arange(none), none)[::-1])[::-1], none]
    last = np.cumsum(windows)
    now = following[last - windows]
    while True:
        open_ = np.flatnonzero(now < last)
        if not len(open_):
            return reach_before, reach_after
        factor = now[open_]
        size = length - 1 + longest[factor]
        there = at[start[source[first_run[factor] + longest[factor] - 1]]]
        same = np.logical_and.reduceat(words[ranges(at[factor], size)] == words[ranges(there, size)], np.cumsum(size) - size)
        right, factor, size = open_[same], factor[same], size[same]
        reach_before[right] = np.maximum(reach_before[right], before[right] - nth[factor])
        reach_after[right] = np.maximum(reach_after[right], nth[factor] + size - before[right])
        # the next window that goes beyond the factor's end
        now[open_] = following[now[open_] + longest[now[open_]]]


def remove_words(text: bytes, spans: list[tuple[int, int]], whole: bool, length: int = WORDS.length) -> tuple[int, int, int, bytes]:
    words = text.split()
    if whole:
        spans = [(0, len(words))] if len(words) >= length else []
    if not spans:
        return len(words), 0, 0, b" ".join(words)
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    kept += words[at:]
    return len(words), len(words) - len(kept), len(spans), b" ".join(kept)


def _words_only(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


def remove_repeated_words(docs: DataFrame, outputs: dict[str, str], id_col: str = "doc_id", text_col: str = "text", spec: Windows = WORDS) -> DataFrame:
    """docs with outputs (name: one of n_items, n_removed, n_spans, kept_text, kept_sha256) added.

    Words are separated by ASCII white space. Every word in a window of spec.length words that also starts in a
    document of a smaller id is removed, all judged on the input. Ids are integers; a null id is larger than any
    other. Null and empty texts have no words; rows that repeat an id do not count as earlier for each other;
    an empty table gives no rows. docs is read once, into a numbered copy that every later pass reads.
    """
    docs = numbered(docs)
    marked = marks(docs, id_col, text_col, spec, lambda *a: factors(*a, length=spec.length), _words_only)
    return without_marks(docs, marked, lambda t, s, w: remove_words(t, s, w, spec.length), outputs, text_col)
