import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rollcall.llm import common
from rollcall.llm.simhash import drop_near_copies, fingerprint, forest, near_edges, near_pairs, simhash_groups


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in [None, "", " \n ", "One", "A b", "a B c", "É x y\tz  w", "the cat sat on the mat " * 9, "x y z w " * 1001]:
        assert fingerprint(text) == brute_fingerprint(text)


def brute_pairs(keys, prints):
    return {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if keys[i] == keys[j] and (int(prints[i]) ^ int(prints[j])).bit_count() <= 2}


def test_bit_sliced_pairs():
    rng = random.Random(3)
    for n, kinds in [(0, 1), (1, 1), (2, 1), (64, 1), (65, 2), (300, 3), (300, 90)]:
        base = [rng.getrandbits(64) for _ in range(max(1, n // 6))]
        prints = np.array([rng.choice(base) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for _ in range(n)], np.uint64)
        keys = np.sort(np.array([rng.randrange(kinds) for _ in range(n)], np.int64))
        assert set(zip(*map(np.ndarray.tolist, near_pairs(keys, prints)))) == brute_pairs(keys, prints)


def brute_components(ids, prints):
    label = list(range(len(ids)))
    for _ in ids:
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    return {ids[i]: min(ids[j] for j in range(len(ids)) if label[j] == label[i]) for i in range(len(ids))}


def test_edges_connect_like_all_links_even_if_every_key_is_hot(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = sorted({rng.choice(base) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(120)} | set(base))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute_components(signed, prints)
    for hot in (4096, 2):
        edges = [(r.u, r.v) for r in near_edges(df, hot=hot).collect()]
        place = {x: i for i, x in enumerate(signed)}
        label = forest(len(signed), np.array([place[u] for u, _ in edges]), np.array([place[v] for _, v in edges]))
        got = {}
        for i, x in enumerate(signed):
            got.setdefault(label[i], []).append(x)
        expected = {}
        for x, root in want.items():
            expected.setdefault(root, []).append(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("heavy", [1_000, 1])
def test_groups_against_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 400))]
        for _ in range(3):
            copy = words[:]
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", " ", "same text here now", "SAME text  here now"]
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long").repartition(5)
    ids = [r[0] for r in sorted(rows)]
    want = brute_components(ids, [brute_fingerprint(t) for t in texts])
    docs.write.mode("overwrite").parquet(path := spark.conf.get("spark.checkpoint.dir") + "/simhash-in")
    docs = spark.read.parquet(path)
    got = {r.doc_id: r.component_id for r in simhash_groups(docs).collect()}
    assert got == want
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_radius_beyond_the_keys_is_refused(spark):
    with pytest.raises(ValueError, match="radius 3"):
        simhash_groups(spark.createDataFrame([(1, "a")], "doc_id long, text string"), radius=3)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "alone in the world")], "doc_id long, text string").coalesce(1)
    rows = simhash_groups(docs).collect()
    assert [r.component_id for r in rows if r.doc_id == 1] == [1, 1] and sum(r.kept for r in rows) == 2
    assert sorted(str(r.doc_id) for r in drop_near_copies(docs).collect()) == ["1", "None"]
    assert simhash_groups(docs.where(F.lit(False))).count() == 0
