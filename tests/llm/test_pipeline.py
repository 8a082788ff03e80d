import random

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm.simhash import fingerprint


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    benchmark = [(i, " ".join(prose(30))) for i in range(5)] + [(9, None), (10, "short one")]
    docs, labels = [], []
    for i in range(400):
        words = prose(rng.randrange(20, 200))
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "vile")
        docs.append([i, " ".join(words)])
        labels.append((i, 1, int(toxic)))
    for i in range(400, 440):
        docs.append([i, docs[i - 400][1].replace(" ", "  ")])
    for i in range(440, 470):
        words = docs[i - 440][1].split()
        docs.append([i, " ".join(words[:-1] + ["Other"])])
    for i in range(470, 490):
        docs.append([i, " ".join(prose(60)) + " " + benchmark[i % 5][1]])
    docs += [[490, None], [491, ""], [492, None], [493, "short one"]]
    path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-in"
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    return path, dict(docs), {i for i, _, t in labels if t}, benchmark


def brute(docs, toxic_ids, benchmark):
    docs = {i: t for i, t in docs.items() if "vile" not in (t or "").split()}
    seen, kept = set(), {}
    for i in sorted(docs):
        key = " ".join((docs[i] or "").split())
        if key not in seen:
            seen.add(key)
            kept[i] = docs[i]
    prints = {i: fingerprint(t) for i, t in kept.items()}
    label = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for i in kept:
            for j in kept:
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= 2:
                    label[i], changed = label[j], True
    kept = {i: t for i, t in kept.items() if label[i] == i}
    items = [t.lower().split() for _, t in benchmark if t]
    windows = [w[k : k + 13] for w in items for k in range(max(1, len(w) - 12))]
    clean = {}
    for i, t in kept.items():
        words = (t or "").lower().split()
        hit = set()
        for w in windows:
            for k in range(len(words) - len(w) + 1):
                if words[k : k + len(w)] == w:
                    hit |= set(range(k, k + len(w)))
        if not (hit and 20 * len(hit) >= len(words)):
            clean[i] = t
    return clean


def test_against_brute_force(spark, folder):
    path, docs, toxic, benchmark = folder
    out = corpus_pipeline.run(spark, path)
    rows = out.collect()
    want = brute(docs, toxic, benchmark)
    assert sorted(r.doc_id for r in rows) == sorted(want)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows:
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids) == len(r.ids) // 4


def test_stages_keep_the_columns(spark, folder):
    path = folder[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).schema == docs.schema
    empty = docs.limit(0)
    empty.write.mode("overwrite").parquet(f"{path}/none")
    empty = spark.read.parquet(f"{path}/none")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0
