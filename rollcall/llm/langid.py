"""Language ID: each document is a mixture of languages, fitted by expectation-maximisation."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import materialise, ranges, small, text_batches
from rollcall.llm.hashing import mix, range_hashes

UNKNOWN = "und"
SALTS = 32


@dataclass(frozen=True)
class Mixture:
    """rows: documents of each language to learn from at most (those of the smallest hash of the id); languages: how many the table may have; more are refused, none is left out.

    bits: log2 of the n-gram table; smooth: count added to every n-gram; rounds: EM steps; penalty: log-likelihood
    that each further language must gain for each logarithm of the number of words (words that languages share make more than the Bayesian 1/2 necessary).
    """

    rows: int = 1_500
    languages: int = 1024
    bits: int = 15
    smooth: float = 0.5
    rounds: int = 6
    penalty: float = 4.0


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter; its lower-case form, if that is one character."""
    points = [chr(c) for c in range(sys.maxunicode + 1)]
    lower = np.array([ord(x) if len(x := p.lower()) == 1 else i for i, p in enumerate(points)], np.uint32)
    return np.array([p.isalpha() for p in points]), lower


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the words (runs of letters) of all texts: the row of each, their lower-cased letters end to end with a zero before and after each word, and how many of these each has."""
    is_letter, lower = _letters()
    encoded = [t.encode("utf-32-le", "surrogatepass") if t else b"" for t in texts.to_pylist()]
    offsets = np.cumsum([0, *[len(e) // 4 for e in encoded]])
    points = np.frombuffer(b"".join(encoded), np.uint32)
    letter = is_letter[points]
    before = np.zeros(len(points), bool)
    before[1:] = letter[:-1]
    before[offsets[:-1][offsets[:-1] < len(points)]] = False
    start = letter & ~before
    starts = np.flatnonzero(start)
    row = np.searchsorted(offsets, starts, side="right") - 1
    at = np.flatnonzero(letter)
    of = (np.cumsum(start) - 1)[at]
    sizes = np.bincount(of, minlength=len(starts)) + 2
    padded = np.zeros(int(sizes.sum()), np.uint64)
    padded[np.arange(len(at)) + 2 * of + 1] = lower[points[at]]
    return row, padded, sizes


def word_grams(padded: np.ndarray, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each word's n-grams start, and the n-grams' numbers.

    A word's n-grams are those of one to three lower-cased letters, the word's ends being letters of their own, that end
    at its second letter, a later one or the closing end: three for each letter.
    """
    first = np.cumsum(sizes) - sizes
    # one n-gram of each length ends at every letter, and at the closing end those of two and three
    one, two = padded[:-2], padded[1:-1]
    three = padded[2:]
    shift = np.uint64(64 - bits)
    keys = np.stack([mix(three + np.uint64(1)), mix(three + (two << np.uint64(21)) + np.uint64(1 << 50)), mix(three + (two << np.uint64(21)) + (one << np.uint64(42)) + np.uint64(1 << 63))]) >> shift if len(padded) > 2 else np.zeros((3, 0), np.uint64)
    # position p of keys ends at padded[p + 2]; a word of n letters has padded first + 1 ... first + n + 1, from first + 2 on all three lengths lie in it
    inner = ranges(first, sizes - 2)
    return 3 * (np.cumsum(sizes - 2) - (sizes - 2)), keys[:, inner].T.astype(np.int64).ravel()


def grams(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the words of all texts: the row of each, where its n-grams start, and the n-grams' numbers."""
    row, padded, sizes = words(texts)
    return row, *word_grams(padded, sizes, bits)


def word_scores(texts: pa.Array, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word, and its log-likelihood in each language (words x languages). Equal words (by a 64-bit hash) are scored once."""
    row, padded, sizes = words(texts)
    if not len(row):
        return row, np.zeros((0, table.shape[1]))
    first = np.cumsum(sizes) - sizes
    _, at, same = np.unique(range_hashes(padded, first + 1, first + sizes - 1), return_index=True, return_inverse=True)
    begins, found = word_grams(padded[ranges(first[at], sizes[at])], sizes[at], bits)
    return row, np.add.reduceat(table[found], begins, axis=0, dtype=np.float64)[same]


def mixtures(row: np.ndarray, scores: np.ndarray, n: int, spec: Mixture, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (n x languages) that EM finds for each of n rows, and the log-likelihood of its words under them."""
    k = scores.shape[1]
    share = np.full((n, k), 1.0 / max(k, 1)) if allowed is None else allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    if not len(row):
        return share, np.zeros(n)
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    rows = row[starts]
    words = np.diff(np.r_[starts, len(row)])[:, None]
    top = scores.max(1)
    likely = np.exp(scores - top[:, None])
    local = np.repeat(np.arange(len(rows)), words[:, 0])
    mine = share[rows]
    # with one language to choose from there is nothing to fit
    for _ in range(spec.rounds if k > 1 and (mine > 0).sum(1).max() > 1 else 0):
        given = np.maximum(np.einsum("wk,wk->w", likely, mine[local]), 1e-300)
        mine = mine * np.add.reduceat(likely / given[:, None], starts, axis=0) / words
    share[rows] = mine
    total = np.zeros(n)
    total[rows] = np.add.reduceat(np.log(np.maximum(np.einsum("wk,wk->w", likely, mine[local]), 1e-300)) + top, starts)
    return share, total


def identify(texts: pa.Array, table: np.ndarray, spec: Mixture) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: the set of languages (as a mask), proportions within it, and whether it has a letter.

    Sets of 1, 2, ... languages, in the order of the full mixture's proportions, compete by log-likelihood less
    the penalty; a larger set is tried only while the set before it was an improvement and its language has a share.
    """
    n, k = len(texts), table.shape[1]
    row, scores = word_scores(texts, table, spec.bits)
    words = np.bincount(row, minlength=n)
    full, _ = mixtures(row, scores, n, spec)
    order = np.argsort(-full, axis=1, kind="stable")
    chosen = np.zeros((n, k), bool)
    best_share, best = np.zeros((n, k)), np.full(n, -np.inf)
    open_rows = words > 0
    for size in range(1, k + 1):
        allowed = np.zeros((n, k))
        np.put_along_axis(allowed, order[:, :size], 1.0, axis=1)
        if size > 1:
            open_rows &= np.take_along_axis(full, order[:, size - 1 : size], axis=1)[:, 0] > 1e-3
        if not open_rows.any():
            break
        used = open_rows[row]
        share, total = mixtures(row[used], scores[used], n, spec, allowed)
        value = total - spec.penalty * (size - 1) * np.log(np.maximum(words, 2))
        better = open_rows & (value > best)
        best[better], best_share[better], chosen[better] = value[better], share[better], allowed[better] > 0
        open_rows &= better
    return chosen, best_share, words > 0


def train(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", spec: Mixture = Mixture()) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and the log-probability of each n-gram in each (2^bits x languages) from a bounded sample of docs.

    Rows without language or id teach nothing. Every language there is is learned; more than spec.languages are an
    error. The counts of n-grams that reach the driver are at most 2^bits numbers for each language.
    """
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("l"), F.col(id_col).alias("i"))
    names = sorted(r.l for r in known.select("l").distinct().limit(spec.languages + 1).collect())
    if len(names) > spec.languages:
        raise ValueError(f"more than {spec.languages} languages: a larger table has to be asked for")
    if not names:
        return [], np.zeros((1 << spec.bits, 0), np.float32)
    # the first rows of each of SALTS parts of a language, then of the language: no task sorts more than SALTS x rows of one language
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("i"), "i"))
    chosen = known.where(F.col("i").isNotNull()).withColumn("salt", F.pmod(F.hash("i"), F.lit(SALTS)))
    for by in (("l", "salt"), ("l",)):
        chosen = chosen.withColumn("r", rank(*by)).where(F.col("r") <= spec.rows)
    chosen = chosen.select("l", "i")
    rows = docs.select(F.col(lang_col).alias("l"), F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(small(materialise(chosen.distinct())), ["l", "i"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << spec.bits
        sums: dict[int, np.ndarray] = {}
        for batch in text_batches(batches, 1):
            row, first, found = grams(batch.column(1), spec.bits)
            code = np.array([names.index(x) for x in batch.column(0).to_pylist()])
            of = np.repeat(code[row], np.diff(np.r_[first, len(found)]))
            for c in np.unique(code):
                sums[c] = sums.get(c, 0) + np.bincount(found[of == c], minlength=size)
        for code, values in sums.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), code, np.int16)), pa.array(at.astype(np.int32)), pa.array(values[at].astype(np.int64))], names=["l", "g", "n"])

    counts = rows.select("l", "t").mapInArrow(count, "l short, g int, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    # a language at a time, so that the driver holds one's counts, 2^bits at most, beside the table
    by_language = counts.groupBy("l").agg(F.collect_list(F.struct("g", "n")).alias("c"))
    table = np.full((1 << spec.bits, len(names)), spec.smooth, np.float32)
    for row in by_language.toLocalIterator():
        g, n = np.array(row.c, np.int64).T
        table[g, row.l] += n
    return names, np.log(table / table.sum(0, dtype=np.float64)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", spec: Mixture = Mixture()) -> DataFrame:
    """docs with lang_pred, score and langs (each language of the chosen set with its proportion of the words) added; columns of those names are replaced.

    lang_pred is the language with the largest proportion, which is its score; texts that are null or have no
    letter, and all texts if nothing was learned, get `und`, 0 and no languages. No shuffle.
    """
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)
    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "langs": T.MapType(T.StringType(), T.DoubleType())}
    kept = [f for f in docs.schema.fields if f.name not in added]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias("__rc_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, len(kept)):
            n = batch.num_rows
            if names:
                chosen, share, some = identify(batch.column(len(kept)), shared.value, spec)
                best = share.argmax(1)
                langs = [[(names[i], float(share[r, i])) for i in np.flatnonzero(chosen[r])] if some[r] else [] for r in range(n)]
                pred = [names[b] if ok else UNKNOWN for b, ok in zip(best, some)]
                scores = np.where(some, np.clip(share[np.arange(n), best], 0, 1), 0.0)
            else:
                langs, pred, scores = [[]] * n, [UNKNOWN] * n, np.zeros(n)
            made = [pa.array(pred, pa.string()), pa.array(scores), pa.array(langs, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=[*[f.name for f in kept], *added])

    return rows.mapInArrow(run, T.StructType([*kept, *[T.StructField(k, v) for k, v in added.items()]]))
