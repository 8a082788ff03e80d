import hashlib
import random
import re

from pyspark.sql import functions as F

from rollcall.llm import decontaminate, exact
from rollcall.llm.decontaminate import contamination, drop_contaminated


def save(spark, rows, schema, name):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}"
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_exact(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a  b", "a b", "a\tb", "ab", " a b", "", " ", None, "x" * 300 + "1", "x" * 300 + "2", "long " * 20_000, f"only {i}", "é", "a b"]), i % 2) for i in range(80)]
    rows += [(5, rows[5][1], 1), (None, "a b", 0), (None, None, 0), (7000, "hot", 1), *[(8000 + i, "hot", 1) for i in range(200)]]
    rng.shuffle(rows)
    docs = save(spark, rows, "doc_id long, text string, kept int", "exact")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    want = sorted((str(i), str(least[norm(t)]), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, _ in rows)
    for limit, heavy in ((exact.BROADCAST_ROWS, exact.HEAVY_ROWS), (0, 3)):
        monkeypatch.setattr(exact, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(exact, "HEAVY_ROWS", heavy)
        got = exact.exact_groups(docs, carry={"sha": F.sha2(exact.normalised(F.col("text")), 256)}).collect()
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.sha) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    left = exact.drop_exact_copies(docs)
    assert left.schema == docs.schema and sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i in least.values())
    assert exact.exact_groups(docs.where(F.lit(False))).count() == 0


def brute(text, items, window=13):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    words, hit, found = split(text), set(), set()
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            part = w[k : k + window]
            for s in range(len(words) - len(part) + 1):
                if words[s : s + len(part)] == part:
                    hit |= set(range(s, s + len(part)))
                    found.add(i)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


def test_contamination(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ñu", "a1"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([2, 5, 13, 14, 30])))) for i in range(12)] + [(50, None), (51, " - "), (None, "null item has words too"), (3, "w1 w2 w3 repeated id")]
    rows = []
    for i in range(80):
        words = prose(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            t = rng.choice(items)[1] or ""
            at = rng.randrange(len(words) + 1)
            words[at:at] = t.split()[rng.randrange(3) :]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words).replace("w1 ", "W1 "), 1))
    rows += [(100, None, 1), (101, "", 1), (102, "null ITEM has words too", 1), (103, " ".join(prose(30_000)), 1), (7, "another row of seven", 1), (None, items[0][1], 1)]
    docs = save(spark, rows, "doc_id long, text string, n_hit int", "cont")
    benchmark = save(spark, items, "item_id long, text string", "cont-b")
    want = sorted((str(i), *brute(t, items)) for i, t, _ in rows)
    for limit in (decontaminate.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
        got = contamination(docs, benchmark).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in got) == want
        assert all(r.n_hit == sum(s.end - s.i for s in r.spans) and r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    clean = drop_contaminated(docs, benchmark)
    assert clean.schema == docs.schema and sorted(str(r.doc_id) for r in clean.collect()) == sorted(i for i, n, h, _ in want if not (h and 20 * h >= n))
    none = contamination(docs, benchmark.where(F.lit(False))).collect()
    assert len(none) == len(rows) and not any(r.n_hit or r.contaminated for r in none)
    assert contamination(docs.where(F.lit(False)), benchmark).count() == 0


def shuffled_bytes(spark):
    sc = spark.sparkContext
    store, array = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0)
    stages = store.stageList(sc._jvm.java.util.ArrayList(), False, False, array, sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_shuffled_windows_do_not_carry_their_document(spark, monkeypatch):
    rng = random.Random(3)
    long = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    docs = save(spark, [(1, " ".join(long)), (2, "short one"), (3, None)], "doc_id long, text string", "long")
    items = spark.createDataFrame([(7, " ".join(long[500:530])), (8, " ".join(long[900:905])), (9, "nothing of it")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    before = shuffled_bytes(spark)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in contamination(docs, items).collect()}
    assert got == {1: (20_000, 35, ["7", "8"]), 2: (2, 0, []), 3: (0, 0, [])}
    assert 0 < shuffled_bytes(spark) - before < 10_000_000
