import hashlib
import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollcall.llm.substring import WORDS, remove_repeated_words
from rollcall.llm.suffix import BYTES, common, maximal_groups, remove_repeated_bytes, repeat_groups

OUT = {"n": "n_items", "gone": "n_removed", "parts": "n_spans", "sha": "kept_sha256", "kept": "kept_text"}


def table(spark, rows, name):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}"
    spark.createDataFrame(rows, "doc_id long, text string, id string, n long, spans int").repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def covered(n, starts, length):
    hit = [False] * n
    for s in starts:
        hit[s : s + length] = [True] * length
    return hit


def brute_words(rows, length):
    ids = [float("inf") if r[0] is None else r[0] for r in rows]
    words = [(r[1] or "").encode().split() for r in rows]
    least = {}
    for i, w in zip(ids, words):
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in zip(ids, words):
        hit = covered(len(w), [s for s in range(len(w) - length + 1) if least[tuple(w[s : s + length])] < i], length)
        out.append((len(w), sum(hit), b" ".join(x for x, h in zip(w, hit) if not h)))
    return out


def brute_bytes(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = defaultdict(int)
    for t in texts:
        for s in range(len(t) - length + 1):
            seen[t[s : s + length]] += 1
    out = []
    for t in texts:
        hit = covered(len(t), [s for s in range(len(t) - length + 1) if seen[t[s : s + length]] > 1], length)
        parts = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(t), sum(hit), parts, bytes(b for b, h in zip(t, hit) if not h)))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 5 == 0 else f"w{i}" for i in range(300)]
    passage = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    common_one = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
            kind = rng.random()
            if kind < 0.3:
                words += common_one
            elif kind < 0.7:
                p = rng.choice(passage)
                cut = rng.randrange(len(p))
                words += p[cut:] if rng.random() < 0.5 else p[: cut + 1]
        if rng.random() < 0.1:
            words += ["again"] * rng.randrange(1, 90)
        text = rng.choice([" ", "\n"]).join(words)
        rows.append((i, text))
        if rng.random() < 0.15:
            rows.append((i + 1000, text))
        if rng.random() < 0.1:
            rows.append((i, text.replace(" ", "  ")))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, rows[3][1]), (None, rows[4][1] + " tail"), (None, rows[4][1] + " tail"), (6000, "long " + " ".join(rng.choice(vocabulary) for _ in range(30_000)))]
    rng.shuffle(rows)
    return [(a, b, "x", 1, 2) for a, b in rows]


@pytest.mark.parametrize("hot", [4096, 1])
def test_words(spark, hot):
    rows = corpus(11)
    docs = table(spark, rows, f"words-{hot}")
    got = sorted((str(r.doc_id), r.text or "", r.n, r.gone, r.kept, r.sha) for r in remove_repeated_words(docs, OUT, spec=replace(WORDS, hot=hot)).collect())
    want = sorted((str(r[0]), r[1] or "", n, gone, kept, hashlib.sha256(kept).hexdigest()) for r, (n, gone, kept) in zip(rows, brute_words(rows, 13)))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert got == want
    assert sum(w[3] for w in want) > 1000


@pytest.mark.parametrize("hot", [4096, 1])
def test_bytes(spark, hot):
    rows = corpus(13)
    docs = table(spark, rows, f"bytes-{hot}")
    got = sorted((str(r.doc_id), r.text or "", r.n, r.gone, r.parts, r.kept) for r in remove_repeated_bytes(docs, OUT, spec=replace(BYTES, hot=hot)).collect())
    want = sorted((str(r[0]), r[1] or "", *w) for r, w in zip(rows, brute_bytes(rows, 200)))
    assert got == want
    assert sum(w[3] for w in want) > 1000


def test_empty(spark):
    docs = table(spark, [(1, "x", "", 1, 1)], "none").where(F.lit(False))
    assert remove_repeated_words(docs, OUT).count() == 0 and remove_repeated_bytes(docs, OUT).count() == 0


def test_groups_reach_as_far_as_any_pair():
    rng = random.Random(2)
    for _ in range(200):
        n, length = rng.randrange(2, 14), 8
        suffixes = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(n))
        lefts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(7))) for _ in range(n)]
        lcp = [common(a, b) for a, b in zip(suffixes, suffixes[1:])]
        cover = lambda found: [{x for m, l, r in found if m == i for x in range(-l, r)} for i in range(n)]
        pairs = [(i, common(lefts[i], lefts[j]), common(suffixes[i], suffixes[j])) for i in range(n) for j in range(n) if i != j]
        assert cover([(m, l, r) for l, r, members in maximal_groups(lcp, lefts, length) for m in members]) == cover([p for p in pairs if p[1] + p[2] >= length])


def test_groups_are_maximal_and_complete():
    rng = random.Random(4)
    for _ in range(200):
        n, length = rng.randrange(2, 12), 5
        suffixes = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(7))) for _ in range(n))
        lefts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))) for _ in range(n)]
        got = sorted((l, r, sorted(m)) for l, r, m in maximal_groups([common(a, b) for a, b in zip(suffixes, suffixes[1:])], lefts, length))
        want = set()
        for i in range(n):
            for j in range(i):
                l, r = common(lefts[i], lefts[j]), common(suffixes[i], suffixes[j])
                if l + r >= length:
                    want.add((l, r, tuple(k for k in range(n) if common(lefts[i], lefts[k]) >= l and common(suffixes[i], suffixes[k]) >= r)))
        assert got == sorted((l, r, list(m)) for l, r, m in want)


def test_repeat_groups_cover_what_is_removed(spark):
    rows = corpus(17, 40)
    docs = table(spark, rows, "groups")
    texts = {(r[0], r[1]): (r[1] or "").encode() for r in rows}
    listed = repeat_groups(docs).collect()
    content, hit = defaultdict(set), defaultdict(int)
    by_id = defaultdict(list)
    for (i, _), t in texts.items():
        by_id[i].append(t)
    for r in listed:
        content[r.repeat].add(tuple(t[r.start : r.start + r.length] for t in by_id[r.doc_id] if len(t) >= r.start + r.length))
        hit[r.repeat] += 1
    assert listed and all(n > 1 for n in hit.values())
    single = [r for r in rows if len(by_id[r[0]]) == 1]
    spans = defaultdict(set)
    for r in listed:
        spans[r.doc_id] |= set(range(r.start, r.start + r.length))
    want = {r[0]: w[1] for r, w in zip(rows, brute_bytes(rows, 200))}
    assert all(len(spans[r[0]]) == want[r[0]] for r in single)
