"""Quality: a linear-chain conditional random field over lines, pooled to documents by line length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import flat_bytes, text_batches
from rollcall.llm.hashing import range_hashes, spans
from rollcall.llm.sampling import labelled_sample


@dataclass(frozen=True)
class Crf:
    """rows: labelled rows to learn from at most; rounds: how often the lines of bad documents are labelled, at most; steps and rate of the gradient ascent; l2: penalty on the weights."""

    rows: int = 6_000
    rounds: int = 3
    steps: int = 160
    rate: float = 0.15
    l2: float = 1e-4


_BYTES = np.arange(256)
WORD = ~np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LETTER = UPPER | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
#: Signs, without those that prose is full of.
SIGN = (_BYTES > 32) & (_BYTES < 127) & ~LETTER & ~DIGIT & ~np.isin(_BYTES, list(b".,;:'\"-()?"))

#: Upper bounds of the bins that each measure of a line falls into.
BINS = {
    "bytes": [1, 20, 60, 150, 400, 1500],
    "words": [1, 3, 8, 20, 60, 250],
    "word_bytes": [2.5, 4, 5.5, 7, 10],
    "upper": [0.02, 0.08, 0.2, 0.6],
    "signs": [0.005, 0.03, 0.08, 0.15, 0.3],
    "digits": [0.01, 0.1, 0.3],
    "same_as_last_word": [0.01, 0.05, 0.2, 0.6],
    "same_as_last_line": [0.5],
    "stop_at_end": [0.5],
}
WIDTHS = [len(b) + 1 for b in BINS.values()]
N_BINS = sum(WIDTHS)
#: A weight for each bin of the line, of the line before and of the line after, for no line before and after, and the bias.
N_WEIGHTS = 3 * N_BINS + 3


def lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length in bytes, and bin number for each measure of every line that is not empty."""
    data, offsets = flat_bytes(texts)
    starts, ends, rows = spans(data, offsets, _BYTES != 10)
    n = len(starts)
    if not n:
        return rows, starts, np.zeros((0, len(BINS)), np.int32)
    size = ends - starts

    def count(kind: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=sums[1:])
        return sums[ends] - sums[starts]

    w_start, w_end, w_row = spans(data, offsets, WORD)
    words = range_hashes(data, w_start, w_end)
    line = np.searchsorted(starts, w_start, side="right") - 1
    n_words = np.bincount(line, minlength=n)
    repeated = np.zeros(len(words), bool)
    repeated[1:] = (words[1:] == words[:-1]) & (line[1:] == line[:-1])
    letters, whole = count(LETTER), range_hashes(data, starts, ends)
    again = np.zeros(n, bool)
    again[1:] = (whole[1:] == whole[:-1]) & (rows[1:] == rows[:-1])
    values = {
        "bytes": size, "words": n_words, "word_bytes": count(WORD) / np.maximum(n_words, 1), "upper": count(UPPER) / np.maximum(letters, 1),
        "signs": count(SIGN) / size, "digits": count(DIGIT) / size, "same_as_last_word": np.bincount(line, repeated, n) / np.maximum(n_words, 1),
        "same_as_last_line": again, "stop_at_end": np.isin(data[ends - 1], list(b".!?")),
    }
    at = np.cumsum([0, *WIDTHS[:-1]])
    return rows, size, np.stack([a + np.searchsorted(BINS[k], values[k], side="left") for a, k in zip(at, BINS)], axis=1).astype(np.int32)


def active(rows: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The numbers of the weights that apply to each line."""
    n, k = bins.shape
    before, after = np.full((n, k), 3 * N_BINS), np.full((n, k), 3 * N_BINS + 1)
    same = rows[1:] == rows[:-1]
    before[1:][same] = bins[:-1][same] + N_BINS
    after[:-1][same] = bins[1:][same] + 2 * N_BINS
    return np.concatenate([bins, before, after, np.full((n, 1), 3 * N_BINS + 2)], axis=1)


def marginals(rows: np.ndarray, scores: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(line is good), and the expected number of moves between labels in all rows together (2 x 2).

    scores: log-potential of good (bad has 0); move[a, b]: of label b after a. All rows advance together, line
    by line, longest rows first, so that those still running are always the first ones.
    """
    n = len(rows)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    lengths = np.diff(np.r_[starts, n])
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # rows with more than t lines
    potential = np.zeros((n, 2))
    potential[:, 1] = scores
    potential = np.exp(potential - potential.max(1, keepdims=True))
    step = np.exp(move - move.max())
    forward, backward = np.empty((n, 2)), np.empty((n, 2))
    state = potential[starts] / potential[starts].sum(1, keepdims=True)
    forward[starts] = state
    for t in range(1, int(lengths[0])):
        at = starts[: running[t]] + t
        state = (state[: running[t]] @ step) * potential[at]
        state /= state.sum(1, keepdims=True)
        forward[at] = state
    backward[starts + lengths - 1] = 1
    moves = np.zeros((2, 2))
    for t in range(int(lengths[0]) - 2, -1, -1):
        at = starts[: running[t + 1]] + t
        ahead = potential[at + 1] * backward[at + 1]
        both = forward[at][:, :, None] * step * ahead[:, None, :]
        moves += (both / both.sum((1, 2), keepdims=True)).sum(0)
        state = ahead @ step.T
        backward[at] = state / state.sum(1, keepdims=True)
    belief = forward * backward
    return belief[:, 1] / belief.sum(1), moves


def learn(rows: np.ndarray, bins: np.ndarray, labels: np.ndarray, spec: Crf, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the lines and of the moves that make the labels of the lines likeliest (Adam on the exact gradient)."""
    at = active(rows, bins)
    total = np.zeros(N_WEIGHTS + 4) if start is None else start
    seen = np.bincount(at.ravel(), np.repeat(labels, at.shape[1]).astype(float), N_WEIGHTS)
    inner = rows[1:] == rows[:-1]
    seen_moves = np.bincount(2 * labels[:-1][inner] + labels[1:][inner], minlength=4)
    mean, square = np.zeros_like(total), np.zeros_like(total)
    for step in range(1, spec.steps + 1):
        w, move = total[:N_WEIGHTS], total[N_WEIGHTS:].reshape(2, 2)
        good, moves = marginals(rows, w[at].sum(1), move)
        expected = np.bincount(at.ravel(), np.repeat(good, at.shape[1]), N_WEIGHTS)
        gradient = np.r_[seen - expected, seen_moves - moves.ravel()] / max(1, len(rows)) - spec.l2 * total
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        total = total + spec.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return total[:N_WEIGHTS], total[N_WEIGHTS:].reshape(2, 2)


def learn_lines(rows: np.ndarray, size: np.ndarray, bins: np.ndarray, labels: np.ndarray, spec: Crf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, moves and the labels of the lines that these were learned from, by hard EM from the labels that the lines' documents have.

    Every line of a good document is good. Those of a bad one are what weights learned from lines on their own make
    of them, then what the weights of the chain do; but lines of at least half its bytes have to be bad: the likeliest ones.
    """
    inside = np.flatnonzero(labels == 0)

    def relabelled(good: np.ndarray) -> np.ndarray:
        of, good = rows[inside], good[inside]
        worst = np.lexsort((good, of))
        n_bytes = size[inside][worst]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        lengths = np.diff(np.r_[first, len(of)])
        before = np.cumsum(n_bytes) - n_bytes
        before -= np.repeat(before[first], lengths)
        least = np.repeat(np.add.reduceat(n_bytes, first), lengths) / 2
        out = labels.copy()
        out[inside[worst]] = (good[worst] > 0.5) & (before >= least)
        return out

    def chain(of: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w, move = learn(of, bins, lines_of, spec, start)
        return w, move, marginals(of, w[active(of, bins)].sum(1), move)[0]

    lines_of = labels
    if spec.rounds and len(inside):
        lines_of = relabelled(chain(np.arange(len(rows)))[2])
    w, move, good = chain(rows)
    for _ in range(spec.rounds - 1 if len(inside) else 0):
        fresh = relabelled(good)
        if (fresh == lines_of).all():
            break
        lines_of = fresh
        w, move, good = chain(rows, np.r_[w, move.ravel()])
    return w, move, lines_of


def pooled(rows: np.ndarray, size: np.ndarray, good: np.ndarray, n: int, empty: float) -> np.ndarray:
    """The mean of the lines' P(good), weighted by length, for each of n rows; empty where there are no lines."""
    weight = np.bincount(rows, size, n)
    return np.where(weight > 0, np.bincount(rows, size * good, n) / np.maximum(weight, 1), empty)


def scaled(mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The probability that a document is good, from the mean of its lines' P(good)."""
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-scale[0] * np.log(mean / (1 - mean)) - scale[1]))


def learn_scale(mean: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slope and offset of that probability's logit in the mean's, by Newton steps with a small penalty for leaving 1 and 0. They stay so with one label only, or where a larger mean would not be better."""
    start = np.array([1.0, 0.0])
    if len(set(labels.tolist())) < 2:
        return start
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    x = np.stack([np.log(mean / (1 - mean)), np.ones(len(mean))], axis=1)
    scale = start
    for _ in range(20):
        p = scaled(mean, scale)
        slope = x.T @ (labels - p) - (scale - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
        scale = scale + step * min(1.0, 2 / np.abs(step).max()) if step.any() else scale
    return scale if scale[0] > 0 else start


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", spec: Crf = Crf()) -> tuple[list[float], list[float], list[float], float]:
    """Weights, moves, scale (see scaled) and prior from at most spec.rows labelled documents (see labelled_sample), in one task.

    The lines' labels are found from the documents' (see learn_lines). Without any usable label all weights are zero and the prior is one half.
    """
    rows = labelled_sample(docs, labels, label_col, id_col, text_col, spec.rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 2):
            of, size, bins = lines(batch.column(2))
            cut = np.searchsorted(of, np.arange(batch.num_rows + 1))
            bins, size = bins.astype(np.uint8), size.astype(np.int32)
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()) for x in (bins, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *packed], names=["o", "y", "f", "s"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [(y, np.frombuffer(f, np.uint8).reshape(-1, len(BINS)).astype(np.int32), np.frombuffer(s, np.int32)) for b in batches for y, f, s in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
        if not texts:
            return
        n_lines = [len(s) for _, _, s in texts]
        label = np.array([int(y > 0) for y, _, _ in texts])
        size = np.concatenate([s for _, _, s in texts]).astype(np.int64)
        rows, bins = np.repeat(np.arange(len(texts)), n_lines), np.concatenate([f for _, f, _ in texts])
        w, move, _ = learn_lines(rows, size, bins, np.repeat(label, n_lines), spec)
        some = np.array(n_lines) > 0
        mean = pooled(rows, size, marginals(rows, w[active(rows, bins)].sum(1), move)[0], len(texts), 0.5)
        values = np.r_[w, move.ravel(), learn_scale(mean[some], label[some]), (label.sum() + 0.5) / (len(label) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "w"])

    made = rows.mapInArrow(extract, "o long, y int, f binary, s binary").repartition(1).sortWithinPartitions("o", "y").mapInArrow(fit, "at long, w double").collect()
    values = [r.w for r in sorted(made)] or [0.0] * (N_WEIGHTS + 4) + [1.0, 0.0, 0.5]
    return values[:N_WEIGHTS], values[N_WEIGHTS:-3], values[-3:-1], values[-1]


def score(docs: DataFrame, model: tuple[list[float], list[float], list[float], float], text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the quality of each text, 0 to 1, added (a column of that name is replaced). Null, empty and blank-lined texts get the prior. No shuffle."""
    weights, moves, scale, prior = np.array(model[0]), np.array(model[1]).reshape(2, 2), np.array(model[2]), model[3]
    kept = [f for f in docs.schema.fields if f.name != out]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias("__rc_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, len(kept)):
            of, size, bins = lines(batch.column(len(kept)))
            good, _ = marginals(of, weights[active(of, bins)].sum(1), moves)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(np.where(np.bincount(of, minlength=batch.num_rows) > 0, scaled(pooled(of, size, good, batch.num_rows, 0.5), scale), prior))], names=[*[f.name for f in kept], out])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))
