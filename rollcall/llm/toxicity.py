"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import flat_bytes, text_batches
from rollcall.llm.hashing import mix, range_hashes, spans
from rollcall.llm.sampling import labelled_sample


@dataclass(frozen=True)
class Ftrl:
    """bits: log2 of the weights; rows: labelled rows to learn from at most (those with the smallest hash of the id); rates and penalties as published for FTRL-proximal."""

    bits: int = 20
    rows: int = 16_000
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.1


#: Bytes of words: ASCII letters and digits, and all of a character beyond ASCII.
WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of every word, pair of adjacent words and pair with one word between them."""
    data, offsets = flat_bytes(texts)
    data = LOWER[data]
    starts, ends, rows = spans(data, offsets, WORD)
    words = range_hashes(data, starts, ends)
    found_rows, found = [rows], [words]
    for gap in (1, 2):
        same = rows[gap:] == rows[:-gap]
        found_rows.append(rows[gap:][same])
        found.append(mix(words[:-gap][same] * np.uint64(3) + np.uint64(gap)) + words[gap:][same])
    return np.concatenate(found_rows), (mix(np.concatenate(found)) >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(rows: np.ndarray, found: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    """The sorted distinct feature numbers of each of n rows."""
    keys = np.unique((rows.astype(np.int64) << bits) | found)
    return np.split(keys & ((1 << bits) - 1), np.searchsorted(keys >> bits, np.arange(1, n)))


def learn(examples: Iterable[tuple[np.ndarray, int]], spec: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature numbers and weights that are not zero, and the bias, after one pass over (features, label)."""
    size = 1 << spec.bits
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0

    def weight(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((spec.beta + np.sqrt(n)) / spec.alpha + spec.l2))

    for at, label in examples:
        w, bias = weight(z[at], n[at], spec.l1), -bias_z / ((spec.beta + np.sqrt(bias_n)) / spec.alpha)
        gradient = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - label
        square = gradient * gradient
        z[at] += gradient - (np.sqrt(n[at] + square) - np.sqrt(n[at])) / spec.alpha * w
        n[at] += square
        bias_z += gradient - (np.sqrt(bias_n + square) - np.sqrt(bias_n)) / spec.alpha * bias
        bias_n += square
    w = weight(z, n, spec.l1)
    kept = np.flatnonzero(w)
    return kept, w[kept], float(-bias_z / ((spec.beta + np.sqrt(bias_n)) / spec.alpha))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", spec: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray, float]:
    """Learns from at most spec.rows labelled documents (see labelled_sample) in one pass, in one task of bounded memory.

    Without any usable label all weights are zero and the bias is that of one positive in four.
    """
    rows = labelled_sample(docs, labels, label_col, id_col, text_col, spec.rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 2):
            found = _distinct(*features(batch.column(2), spec.bits), batch.num_rows, spec.bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32()))], names=["o", "y", "f"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = learn(((f.values.to_numpy(), y.as_py()) for b in batches for y, f in zip(b.column(1), b.column(2))), spec)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[w, bias])], names=["at", "w"])

    made = rows.mapInArrow(extract, "o long, y int, f array<int>").repartition(1).sortWithinPartitions("o", "y").mapInArrow(fit, "at long, w double").collect()
    model = {r.at: r.w for r in made}
    bias = model.pop(-1, 0.0)
    at = np.array(sorted(model), np.int64)
    return at, np.array([model[i] for i in at]), bias or float(np.log(1 / 3))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text", spec: Ftrl = Ftrl(), out: str = "score") -> DataFrame:
    """docs with the probability of toxicity added (a column of that name is replaced). Null, empty and wordless texts get the bias alone. No shuffle."""
    sparse = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != out]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias("__rc_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = sparse.value
        weights = np.zeros(1 << spec.bits)
        weights[at] = w
        for batch in text_batches(batches, len(kept)):
            of, found = features(batch.column(len(kept)), spec.bits)
            hit = weights[found] != 0
            keys = np.unique((of[hit].astype(np.int64) << spec.bits) | found[hit])
            total = bias + np.bincount(keys >> spec.bits, weights[keys & ((1 << spec.bits) - 1)], batch.num_rows)
            scores = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(scores)], names=[*[f.name for f in kept], out])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))


def drop_toxic(docs: DataFrame, known_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, spec: Ftrl = Ftrl()) -> DataFrame:
    """docs without those that score threshold or more by what the labels of known_docs teach; columns as they were."""
    model = train(known_docs, labels, id_col=id_col, text_col=text_col, spec=spec)
    return score(docs, model, text_col, spec, "__rc_score").where(F.col("__rc_score") < threshold).drop("__rc_score")
