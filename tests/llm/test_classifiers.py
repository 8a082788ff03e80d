import math
import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import langid, quality, toxicity
from rollcall.llm.sampling import in_fold


def save(spark, rows, schema, name):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}"
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_features_are_words_pairs_and_skips():
    rows, found = toxicity.features(pa.array(["One two, three", None, "", "ONE", "é"]), 20)
    assert np.bincount(rows, minlength=5).tolist() == [3 + 2 + 1, 0, 0, 1, 1]
    one = found[rows == 3][0]
    assert one in found[rows == 0]


def test_toxicity(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        bad = rng.random() < 0.3
        if bad:
            text.insert(0, rng.choice(["vile", "nasty"]))
        docs.append((i, " ".join(text), "x"))
        labels.append((i, None if i % 50 == 7 else int(bad)))
    docs += [(9001, None, "x"), (9002, "", "x"), (9003, "vile " * 40_000, "x"), (None, "fine", "x"), (3, docs[3][1], "x")]
    labels += [(3, 0), (None, 1), (123456, 1)]
    docs, labels = save(spark, docs, "doc_id long, text string, score string", "tox"), save(spark, labels, "doc_id long, toxic int", "tox-l")
    model = toxicity.train(docs, labels.where(~in_fold("doc_id", 5, 0)))
    assert 0 < len(model[0]) < 1500
    got = toxicity.score(docs.withColumn("held_out", in_fold("doc_id", 5, 0)), model).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    held = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id != 3]
    assert len(held) > 80 and np.mean([(r.score >= 0.5) == (truth[r.doc_id] == 1) for r in held]) > 0.97
    scores = {r.doc_id: r.score for r in got}
    assert scores[9001] == scores[9002] < 0.5 < scores[9003] and all(0 <= r.score <= 1 for r in got) and len(got) == docs.count()
    none = toxicity.train(docs, labels.where(F.lit(False)))
    assert len(none[0]) == 0 and toxicity.score(docs, none).where("score >= 0.5").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0
    clean = toxicity.drop_toxic(docs, docs, labels)
    assert clean.schema == docs.schema and 9003 not in {r.doc_id for r in clean.collect()}


def test_crf_marginals_against_all_labelings():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        scores, move = rng.normal(size=n), rng.normal(size=(2, 2))
        weight = {y: np.exp(sum(s for s, v in zip(scores, y) if v) + sum(move[a, b] for a, b in zip(y, y[1:]))) for y in product((0, 1), repeat=n)}
        total = sum(weight.values())
        good, moves = quality.marginals(np.zeros(n, int), scores, move)
        assert np.allclose(good, [sum(w for y, w in weight.items() if y[t]) / total for t in range(n)])
        assert np.allclose(moves, [[sum(w * sum((y[t], y[t + 1]) == (a, b) for t in range(n - 1)) for y, w in weight.items()) / total for b in (0, 1)] for a in (0, 1)])
    together, _ = quality.marginals(np.array([0, 0, 1, 2, 2, 2]), np.arange(6) / 3, np.eye(2))
    apart = np.concatenate([quality.marginals(np.zeros(b - a, int), np.arange(6)[a:b] / 3, np.eye(2))[0] for a, b in ((0, 2), (2, 3), (3, 6))])
    assert np.allclose(together, apart)


def test_quality(spark):
    rng = random.Random(2)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(8, 25))) + "."
    junk = lambda: " ".join(["BUY!!"] * rng.randrange(5, 20)) if rng.random() < 0.5 else "a | b | c | ## | d"
    docs, labels = [], []
    for i in range(400):
        bad = rng.random() < 0.3
        docs.append((i, "\n".join((junk if bad and rng.random() < 0.9 else prose)() for _ in range(rng.randrange(1, 8))), 0.5))
        labels.append((i, int(not bad)))
    docs += [(9001, None, 0.5), (9002, "\n\n", 0.5), (9003, (prose() + "\n") * 5_000, 0.5), (9004, "BUY!! " * 50_000, 0.5)]
    docs, labels = save(spark, docs, "doc_id long, text string, score double", "qual"), save(spark, labels, "doc_id long, quality int", "qual-l")
    model = quality.train(docs, labels.where(~in_fold("doc_id", 5, 0)))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.where(in_fold("doc_id", 5, 0)).collect()}
    assert np.mean([(got[i] >= 0.3) == (y == 1) for i, y in truth.items()]) > 0.93
    assert got[9001] == got[9002] and got[9003] > 0.5 and got[9004] < 0.3 and all(0 <= s <= 1 for s in got.values())
    none = quality.train(docs, labels.where(F.lit(False)))
    assert {round(r.score, 6) for r in quality.score(docs, none).collect()} == {0.5}


def test_lines_of_bad_documents_are_told_apart():
    rng = random.Random(5)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(8, 25))) + "."
    junk = lambda: "a | b | c | ## | d | " * rng.randrange(9, 12)
    texts, truth, labels = [], [], []
    for _ in range(300):
        n, bad = rng.randrange(3, 9), rng.random() < 0.5
        at = rng.randrange(n)  # in a bad document a run of junk, which has most of its bytes
        kinds = [not (bad and at <= i < at + (2 * n + 2) // 3) for i in range(n)]
        texts.append("\n".join((prose if k else junk)() for k in kinds))
        truth += kinds
        labels += [int(not bad)] * n
    rows, size, bins = quality.lines(pa.array(texts))
    truth, labels = np.array(truth), np.array(labels)
    _, _, kept = quality.learn_lines(rows, size, bins, labels, quality.Crf(rounds=0))
    w, move, found = quality.learn_lines(rows, size, bins, labels, quality.Crf())
    assert (kept == labels).all() and (found[labels == 1] == 1).all()
    share = [np.sum(size * (found == 0) * (rows == r)) / np.sum(size * (rows == r)) for r in np.unique(rows[labels == 0])]
    assert min(share) >= 0.5
    # lines by the document's label alone, then by the labels that were found
    assert np.mean(kept == truth) < 0.9 < 0.95 < np.mean(found == truth)
    good, _ = quality.marginals(rows, w[quality.active(rows, bins)].sum(1), move)
    assert np.mean((good > 0.5) == truth) > 0.95


def test_lines_with_only_one_label():
    rows, size, bins = quality.lines(pa.array(["one line\ntwo lines", "three"]))
    for label in (0, 1):
        _, _, found = quality.learn_lines(rows, size, bins, np.full(3, label), quality.Crf(steps=5))
        assert (found[[0, 2]] == label).all() if label else found[2] == 0
    empty = quality.learn_lines(rows[:0], size[:0], bins[:0], np.zeros(0, int), quality.Crf(steps=2))
    assert len(empty[2]) == 0


def test_equal_words_score_alike():
    rng = np.random.default_rng(6)
    table = rng.normal(size=(1 << 12, 3)).astype(np.float32)
    texts = ["ab c AB", None, "", "1 2", "É ab", "c " * 50, "x" * 5_000 + " x"]
    row, scores = langid.word_scores(pa.array(texts), table, 12)
    of, first, found = langid.grams(pa.array(texts), 12)
    assert (row == of).all() and np.allclose(scores, [table[found[a:b]].sum(0, dtype=float) for a, b in zip(first, [*first[1:], len(found)])])


def test_grams_of_words():
    row, first, found = langid.grams(pa.array(["ab c", None, "", "1 2", "É", "AB"]), 12)
    assert row.tolist() == [0, 0, 4, 5] and np.diff(np.r_[first, len(found)]).tolist() == [6, 3, 3, 6]
    assert found[0:6].tolist() == found[12:18].tolist()


def test_languages(spark):
    rng = random.Random(3)
    sound = {"xx": ["ka", "ko", "ku", "ki"], "yy": ["ble", "bra", "bli", "bro"], "zz": ["ñe", "ñu", "ssa", "ssi"]}
    word = lambda k: "".join(rng.choice(sound[k]) for _ in range(rng.randrange(1, 4)))
    rows = [(i, " ".join(word(k) for _ in range(rng.randrange(3, 80))), k if i % 9 else None, "s") for i, k in enumerate(rng.choice(list(sound)) for _ in range(300))]
    mixed = " ".join([*(word("xx") for _ in range(200)), *(word("yy") for _ in range(100))])
    rows += [(900, None, "xx", "s"), (901, "", "xx", "s"), (902, "12 34 !", "yy", "s"), (903, mixed, None, "s"), (904, "KAKO " * 30_000, None, "s"), (None, "kako", "xx", "s")]
    docs = save(spark, rows, "doc_id long, text string, lang string, score string", "lang")
    model = langid.train(docs.where(~in_fold("doc_id", 4, 2)))
    assert model[0] == ["xx", "yy", "zz"] and np.allclose(np.exp(model[1].astype(float)).sum(0), 1, atol=1e-3)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    truth = {i: k for i, t, k, _ in rows if i is not None and i < 900 and k}
    assert np.mean([got[i].lang_pred == k for i, k in truth.items()]) > 0.99
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0 and got[904].lang_pred == "xx"
    assert got[903].lang_pred == "xx" and set(got[903].langs) == {"xx", "yy"} and got[903].score == pytest.approx(2 / 3, abs=0.05)
    assert {r.lang_pred for r in langid.predict(docs, ([], np.zeros((1 << 15, 0)))).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_ftrl_as_coordinate_by_coordinate():
    rng, spec = random.Random(3), toxicity.Ftrl(bits=4, alpha=0.5, l1=0.2)
    examples = [(np.array(sorted(rng.sample(range(16), rng.randrange(6))), np.int64), rng.randrange(2)) for _ in range(300)]
    z, n = [0.0] * 17, [0.0] * 17  # the last one is the bias, which has no penalties

    def weight(i):
        l1, l2 = (spec.l1, spec.l2) if i < 16 else (0.0, 0.0)
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((spec.beta + math.sqrt(n[i])) / spec.alpha + l2)

    for found, label in examples:
        at = [*found.tolist(), 16]
        w = {i: weight(i) for i in at}
        gradient = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i in at:
            sigma = (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / spec.alpha
            z[i] += gradient - sigma * w[i]
            n[i] += gradient**2
    at, w, bias = toxicity.learn(examples, spec)
    want = {i: weight(i) for i in range(16) if weight(i)}
    assert 0 < len(want) < 16 and at.tolist() == sorted(want)
    assert np.allclose(w, [want[i] for i in at]) and math.isclose(bias, weight(16))


def test_mixtures_as_word_by_word():
    rng, spec = random.Random(4), langid.Mixture(rounds=5)
    scores = [[[rng.uniform(-9, -1) for _ in range(3)] for _ in range(rng.randrange(1, 6))] for _ in range(20)]
    row = np.repeat(np.arange(20), [len(d) for d in scores])
    share, total = langid.mixtures(row, np.array([w for d in scores for w in d]), 21, spec)
    for d, words in enumerate(scores):
        mine = [1 / 3] * 3
        for _ in range(spec.rounds):
            given = [[m * math.exp(s) for m, s in zip(mine, w)] for w in words]
            mine = [sum(g[k] / sum(g) for g in given) / len(words) for k in range(3)]
        assert np.allclose(share[d], mine)
        assert math.isclose(total[d], sum(math.log(sum(m * math.exp(s) for m, s in zip(mine, w))) for w in words))
    assert np.allclose(share[20], 1 / 3) and total[20] == 0


def test_more_languages_than_asked_for_are_refused(spark):
    docs = spark.createDataFrame([(i, f"word {i}", f"l{i}") for i in range(5)], "doc_id long, text string, lang string")
    assert langid.train(docs, spec=langid.Mixture(languages=5))[0] == ["l0", "l1", "l2", "l3", "l4"]
    with pytest.raises(ValueError, match="more than 4 languages"):
        langid.train(docs, spec=langid.Mixture(languages=4))
