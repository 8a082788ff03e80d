"""SimHash near-duplicates: 64-bit fingerprints, block-keyed candidates, bit-sliced comparison, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import ROW, drop_rows, join_spread, materialise, numbered, text_batches, with_row
from rollcall.operators.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints that share a key beyond which the key is refined by 16 more bits.
HOT = 4096
#: (query, lane word) pairs compared at once.
PAIRS = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is 1 if set in more than half of the XXH64 of the text's word shingles, repeats included; 0 for no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(x, seed) for x in shingles], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Row number, id and fingerprint (as a signed 64-bit integer) of every row."""
    rows = with_row(docs, F.col(id_col).alias(id_col), F.col(text_col).alias("__rc_text")).select(ROW, id_col, "__rc_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 2):
            prints = np.array([fingerprint(t, shingle, seed) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], names=[ROW, id_col, "fp"])

    kept = [f for f in rows.schema.fields if f.name != "__rc_text"]
    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def block_keys(fp: str = "fp") -> list:
    """Six keys: two of four 16-bit blocks each. Words at most two bits apart agree on two blocks at least."""
    block = [F.shiftrightunsigned(F.col(fp), 16 * b).bitwiseAND(F.lit(0xFFFF)) for b in range(4)]
    return [F.xxhash64(F.lit(n), block[a], block[b]) for n, (a, b) in enumerate(combinations(range(4), 2))]


def _sub_keys(fp: str, n: int, key: str) -> list:
    """For key n, six keys that add two of the four bytes in the two blocks that n leaves open."""
    a, b = list(combinations(range(4), 2))[n]
    rest = [x for x in range(4) if x not in (a, b)]
    byte = [F.shiftrightunsigned(F.col(fp), 16 * r + 8 * h).bitwiseAND(F.lit(0xFF)) for r in rest for h in range(2)]
    return [F.xxhash64(F.col(key), F.lit(m), byte[c], byte[d]) for m, (c, d) in enumerate(combinations(range(4), 2))]


def near_pairs(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of equal key whose prints differ in at most radius (0 to 2) bits.

    keys are sorted. Prints lie in lanes of 64 with a word for each bit plane. For each (print, word of lanes
    after it in its run), all 64 distances grow at once in two carry-save counter words and one overflow
    word, and the pair of print and word is abandoned once every lane in it has overflown.
    """
    n = len(keys)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lanes = np.zeros((n + 63) // 64 * 64, np.uint64)
    lanes[:n] = prints
    bits = np.unpackbits(lanes.view(np.uint8), bitorder="little").reshape(-1, 64)  # print x bit
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)  # bit x word
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    ends = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    index = np.arange(n)
    alone = ends - 1 == index
    query = index[~alone]
    first, last = (query + 1) // 64, (ends[query] - 1) // 64
    left, right = [], []
    at = 0
    count = last - first + 1
    done = np.cumsum(count)
    while at < len(query):
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, side="right")))
        q = np.repeat(query[at:stop], count[at:stop])
        w = np.repeat(first[at:stop] - np.cumsum(count[at:stop]) + count[at:stop], count[at:stop]) + np.arange(int(count[at:stop].sum()))
        low, high = np.maximum(q + 1 - 64 * w, 0), np.minimum(ends[q] - 64 * w, 64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        over = ~((full >> (64 - (high - low)).astype(np.uint64)) << low.astype(np.uint64))  # lanes outside the run count as overflown
        ones, twos = np.zeros(len(q), np.uint64), np.zeros(len(q), np.uint64)
        mine = prints[q]
        for p in range(64):
            x = planes[p, w] ^ (np.uint64(0) - ((mine >> np.uint64(p)) & np.uint64(1)))
            carry = ones & x
            ones ^= x
            over |= twos & carry
            twos ^= carry
            if radius < 2:
                over |= twos if radius == 1 else ones | twos
            else:
                over |= twos & ones
            if p % 8 == 7:
                live = over != full
                if not live.all():
                    q, w, over, ones, twos, mine = (v[live] for v in (q, w, over, ones, twos, mine))
                if not len(q):
                    break
        if len(q):
            hit = np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64)
            row, lane = np.nonzero(hit)
            left.append(q[row])
            right.append(64 * w[row] + lane)
        at = stop
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of n reaches over the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (key, fp) sorted by key; each run of a key gives a star for each of its components."""
        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def edges(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            left, right = near_pairs(keys, prints.view(np.uint64), radius)
            used = np.unique(np.r_[left, right])
            label = forest(len(used), np.searchsorted(used, left), np.searchsorted(used, right))
            child = label != np.arange(len(used))
            return pa.RecordBatch.from_arrays([pa.array(prints[used[child]]), pa.array(prints[used[label[child]]])], names=["u", "v"])

        for batch in batches:
            keys = np.r_[held_k, batch.column(0).to_numpy(zero_copy_only=False)]
            prints = np.r_[held_f, batch.column(1).to_numpy(zero_copy_only=False)]
            if not len(keys):
                continue
            cut = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])  # the last run may go on
            if cut:
                yield edges(keys[:cut], prints[:cut])
            held_k, held_f = keys[cut:], prints[cut:]
        if len(held_k) > 1:
            yield edges(held_k, held_f)

    return run


def near_edges(prints: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Edges (u, v) that connect distinct fingerprints (column fp) just as all links within radius do.

    A key shared by more than hot fingerprints is refined by 16 further bits, which loses no link, until at
    most 2^16 different fingerprints can share it: no task ever needs more of one key.
    """
    keyed = materialise(prints.select("fp", F.posexplode(F.array(*block_keys())).alias("n", "key")))
    many = materialise(keyed.groupBy("key").count().where(F.col("count") > hot).select("key", F.lit(True).alias("many")))
    if many.limit(1).count():
        sub = F.lit(None).cast("array<bigint>")
        for n in range(6):
            sub = F.when(F.col("n") == n, F.array(*_sub_keys("fp", n, "key"))).otherwise(sub)
        keyed = keyed.join(many, "key", "left").select("fp", F.explode(F.when(F.col("many"), sub).otherwise(F.array("key"))).alias("key"))
    sorted_rows = keyed.select("key", "fp").repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(_compare(radius), "u bigint, v bigint")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """One row for each row of docs: its number, id, fp (signed 64 bits), component_id and kept.

    Rows are linked when their fingerprints differ in at most radius bits; component_id is the smallest id
    that links reach. Equal fingerprints are one node, so a group of copies adds one row to any comparison.
    Null, empty and blank texts have fingerprint 0 and are linked like any other. kept marks one row of each
    component: the smallest id (null after all others), of rows that repeat it the first. Empty tables give
    no rows. docs must repeat its rows in the same order in every pass, as a table does.
    """
    if radius not in (0, 1, 2):
        raise ValueError(f"radius {radius}: keys of two of four blocks find all links only up to 2 bits")
    rows = materialise(fingerprints(docs, id_col, text_col, shingle, seed))
    first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(ROW).alias("row"))
    nodes = materialise(rows.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("n")))
    roots = components(near_edges(nodes.select("fp"), radius, hot))
    rooted = materialise(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "n", "first", F.coalesce("root", "fp").alias("root")))
    # neither a component of many fingerprints nor a fingerprint of many rows is one task's
    tops = materialise(rooted.groupBy("root").agg(F.min("first").alias("top"), F.count("*").alias("prints")))
    named = materialise(join_spread(rooted.select("fp", "n", "root"), tops, "root", "prints", rooted.count()).select("fp", "n", "top"))
    return join_spread(rows, named, "fp", "n", rows.count()).select(ROW, id_col, "fp", F.col("top.id").alias("component_id"), (F.col("top.row") == F.col(ROW)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component; columns as they were."""
    docs = numbered(docs)
    return drop_rows(docs, simhash_groups(docs, id_col, text_col).where(~F.col("kept")))
